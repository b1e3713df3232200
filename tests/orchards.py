"""An invented table for tests: orchard plots, from two growers with their own layouts."""

import json
import os
import random

from tabflow.spec import FeatureSpec, SourceSpec

SPEC = {"numeric": ["height", "rain", "harvest"], "categorical": ["soil", "variety"], "binary": ["grafted"],
        "target": "blight", "lineage": "source", "key": ["plot"],
        "sources": {"north": {"overwrite_tag": False},
                    "south": {"rename": {"tall": "height", "sick": "blight"}, "recode": {"soil": {"0": 10, "1": 20}},
                              "add": {"grafted": 0}}}}
NORTH_COLS = "plot height rain harvest soil variety grafted blight".split()
NORTH_ROWS = ["1,2.5,700,31,10,russet,1,0", "2,3.25,650,,20,pippin,0,1", "3,4,710,n/a,10,07,1,2"]
SOUTH_COLS = "plot tall rain soil variety sick".split()
SOUTH_ROWS = ["1,2.75,400,0,russet,0", "2,tall,410,1,pippin,1", "3,3.5,NA,5,7,0.5"]


def spec(key=("plot",)):
    return FeatureSpec(**{k: v for k, v in SPEC.items() if k not in ("sources", "key")}, key=key)


def sources():
    return tuple(SourceSpec(name=n, **f) for n, f in SPEC["sources"].items())


def csv(folder, name, cols, rows):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n" + "\n".join(rows) + "\n")
    return path


def spec_file(folder, **changes):
    path = os.path.join(folder, "spec.json")
    with open(path, "w") as f:
        json.dump({**SPEC, **changes}, f)
    return path


def random_rows(n, seed, south=False):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        sick = rnd.randrange(2)
        row = [i, round(rnd.uniform(2, 4) + 0.4 * sick, 2), rnd.randrange(300, 800)]
        row += ([rnd.randrange(2), rnd.choice(["russet", "pippin"]), sick] if south else
                [rnd.randrange(20, 60), rnd.choice([10, 20, 30]), rnd.choice(["russet", "pippin", "codlin"]),
                 rnd.randrange(2), sick])
        out.append(",".join(map(str, row)))
    return out


def frame(spark, n=100, seed=7):
    """The harmonised layout, typed."""
    rows = [r.split(",") for r in random_rows(n, seed)]
    data = [(int(p), float(h), int(r), int(v), s, w, g, int(b)) for p, h, r, v, s, w, g, b in rows]
    return spark.createDataFrame(data, "plot int, height double, rain int, harvest int, soil string, variety string, "
                                       "grafted string, blight int")
