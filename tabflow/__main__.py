"""Command line: the whole analysis over CSV sources.

    python -m tabflow --spec spec.json --source north=path/a.csv --source south=path/b.csv --out results/

``--spec`` is a JSON file of column roles and source layouts (see ``tabflow.spec.load_specs``).
Each ``--source NAME=PATH`` is read as text (any Hadoop file-system URI, a file or a folder); a name
without a layout in the spec is taken as already in the harmonised layout. ``--quick`` uses one
candidate per model family instead of the preset grids.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from tabflow.plans.workflow import DEFAULT_GRIDS, run
from tabflow.session import checkpoint_dir, get_session
from tabflow.sources.io import read_raw
from tabflow.spec import GridSpec, SourceSpec, StackSpec, load_specs

QUICK_GRIDS = (GridSpec("lr", {"C": [1.0]}), GridSpec("rf", {"n_estimators": [50], "max_depth": [8]}),
               GridSpec("gbt", {"n_estimators": [20], "learning_rate": [0.1]}))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tabflow", description=__doc__.splitlines()[0])
    ap.add_argument("--source", action="append", required=True, help="NAME=PATH (repeatable)")
    ap.add_argument("--spec", required=True, help="JSON file of column roles and source layouts")
    ap.add_argument("--out", required=True, help="folder for the combined table and run records")
    ap.add_argument("--folds", type=int, default=5)
    ap.add_argument("--test-frac", type=float, default=0.2)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--no-stack", action="store_true")
    ap.add_argument("--quick", action="store_true")
    ap.add_argument("--master", default=None, help="only for local runs; clusters set it at submit")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    checkpoint_dir(spark)
    spec, known = load_specs(args.spec)
    sources = []
    for item in args.source:
        name, _, path = item.partition("=")
        df = read_raw(spark, path, missing_ok=True)
        if df is None:
            print(f"source {name}: input not found at {path}", file=sys.stderr)
            return 2
        sources.append((df, known.get(name, SourceSpec(name=name))))
    if not spec.key:
        # without a declared key a row is known by its raw values and source; equal rows are
        # interchangeable, and the occurrence number keeps them apart
        spec = replace(spec, key=("row_key",))
        sources = [(df.withColumn("row_key", F.sha2(F.to_json(F.struct(*map(F.col, df.columns)),
                                                              {"ignoreNullFields": "false"}), 256)), src)
                   for df, src in sources]
    res = run(spark, sources, spec, grids=QUICK_GRIDS if args.quick else DEFAULT_GRIDS, k=args.folds,
              test_frac=args.test_frac, seed=args.seed, stack=None if args.no_stack else StackSpec(),
              out_dir=args.out, mode="cli")
    res.metrics.orderBy("model").show(truncate=False)
    res.cv.orderBy("model").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
