"""Harmonise, union, clean, sources and sinks, on an invented table of orchard plots."""

import os

import orchards as O
import pytest
from pyspark.sql import functions as F

from tabflow.operators import clean as C
from tabflow.operators import harmonize as H
from tabflow.sources.io import read_raw


def test_read_raw_shape_and_names(spark, tmp_dir):
    df = read_raw(spark, O.csv(tmp_dir, "plots.csv", O.NORTH_COLS, O.NORTH_ROWS))
    assert df.columns == O.NORTH_COLS and df.count() == 3
    assert all(t == "string" for _, t in df.dtypes)


def test_read_raw_missing_returns_none(spark, tmp_dir):
    assert read_raw(spark, os.path.join(tmp_dir, "nope.csv"), missing_ok=True) is None


def test_read_raw_na_tokens(spark, tmp_dir):
    p = O.csv(tmp_dir, "na.csv", ["a", "b"], ["NA,1", "x,", "nan,NULL"])
    rows = read_raw(spark, p).orderBy("b").collect()
    assert sorted([r.a for r in rows], key=str) == sorted([None, "x", None], key=str)


def test_read_raw_quotes_and_line_breaks(spark, tmp_dir):
    p = O.csv(tmp_dir, "q.csv", ["a", "b"], ['"say ""hi"", twice",1', '"two\nlines",2'])
    assert [(r.a, r.b) for r in read_raw(spark, p, multi_line=True).orderBy("b").collect()] == \
        [('say "hi", twice', "1"), ("two\nlines", "2")]
    assert read_raw(spark, O.csv(tmp_dir, "q2.csv", ["a", "b"], ['"say ""hi"", twice",1'])).first().a == 'say "hi", twice'


def test_read_raw_files_with_other_column_orders(spark, tmp_dir):
    folder = f"{tmp_dir}/parts"
    O.csv(folder, "a.csv", ["x", "y"], ["x1,y1"])
    O.csv(folder, "b.csv", ["y", "x"], ["y2,x2"])
    O.csv(folder, "c.csv", ["y", "x"], ["y3,x3"])
    with pytest.raises(Exception, match="header"):  # never silently in the wrong column
        read_raw(spark, folder).collect()
    rows = read_raw(spark, folder, mixed_headers=True).select("x", "y").collect()
    assert sorted(map(tuple, rows)) == [("x1", "y1"), ("x2", "y2"), ("x3", "y3")]


def test_harmonize_two_sources(spark, tmp_dir):
    north = read_raw(spark, O.csv(tmp_dir, "n.csv", O.NORTH_COLS, O.NORTH_ROWS))
    south = read_raw(spark, O.csv(tmp_dir, "s.csv", O.SOUTH_COLS, O.SOUTH_ROWS))
    spec, (a, b) = O.spec(), O.sources()
    hn, hs = H.harmonize(north, a, spec), H.harmonize(south, b, spec)
    assert hn.columns == hs.columns == list(spec.columns)
    rows = hs.orderBy("plot").collect()
    assert [r.soil for r in rows] == ["10", "20", None]  # recoded; 5 is not in the dictionary
    assert [r.height for r in rows] == [2.75, None, 3.5]  # renamed; a word is no number
    assert [r.rain for r in rows] == [400.0, 410.0, None]
    assert all(r.grafted == 0 and r.harvest is None and r.source == "south" for r in rows)
    assert {r.source for r in hn.collect()} == {"north"}


def test_clean_combined(spark, tmp_dir):
    north = read_raw(spark, O.csv(tmp_dir, "n.csv", O.NORTH_COLS, [*O.NORTH_ROWS, "4,3,600,20,30,codlin,,"]))
    south = read_raw(spark, O.csv(tmp_dir, "s.csv", O.SOUTH_COLS, O.SOUTH_ROWS))
    spec, (a, b) = O.spec(), O.sources()
    got = {(r.source, r.plot): r for r in C.clean(H.combine([(north, a), (south, b)], spec), spec).collect()}
    assert len(got) == 6  # the plot without a target is gone
    assert [got["north", str(i)].blight for i in (1, 2, 3)] == [0, 1, 1]
    assert got["south", "3"].blight == 0 and got["south", "3"].soil == "missing"
    assert got["north", "3"].variety == "07" and got["south", "3"].variety == "7"


def test_category_codes_are_kept(spark):
    codes = ["007", "1e3", "+3", "12345678901234567", "12345678901234568", "3.0", None]
    df = spark.createDataFrame([(i, c, float(i) if i else None, 1.5 * i) for i, c in enumerate(codes)],
                               "i int, c string, n double, h double")
    rows = C.clean_categorical(df, ["c", "n", "h"]).orderBy("i").collect()
    assert [r.c for r in rows] == codes[:-1] + ["missing"]
    assert [r.n for r in rows] == ["missing", "1", "2", "3", "4", "5", "6"]
    assert [r.h for r in rows][:4] == ["0", "1.5", "3", "4.5"]
    odd = spark.createDataFrame([(float("nan"),), (1e30,), (-0.0,)], "n double")
    assert [r.n for r in C.clean_categorical(odd, ["n"]).collect()] == ["missing", "1.0E30", "0"]


def test_numeric_text_edges(spark):
    raw = ["rotten", "NaN", " 12 ", "1d", "1e3", "True", "inf", "", "-.5", "7.", "+3", "nan"]
    want = [None, None, 12.0, None, 1000.0, None, None, None, -0.5, 7.0, 3.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string")
    got = [r.v for r in C.coerce_numeric(df, ["v"]).orderBy("i").collect()]
    assert got == want


def test_binarize_target(spark):
    df = spark.createDataFrame([(1, None), (2, "0"), (3, "0.5"), (4, "1"), (5, "4"), (6, "1e30"), (7, "-1e30"),
                                (8, "1e999"), (9, "wet")], "i int, t string")
    out = C.binarize(C.drop_null_target(df, "t"), "t").orderBy("i").collect()
    assert [r.t for r in out] == [0, 0, 1, 1, 1, 0, None, None]


def test_recode_large_dictionary_uses_join(spark):
    df = spark.range(1, 101).select(F.col("id").cast("string").alias("k"))
    mapping = {i: f"v{i}" for i in range(1, 51)}
    out = H.recode(df, "k", mapping)
    rows = {r.k for r in out.collect()}
    assert rows == {f"v{i}" for i in range(1, 51)} | {None}
    assert "Join" in out._jdf.queryExecution().optimizedPlan().toString()


def test_recode_duplicate_keys_same_on_both_paths(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("2",), ("x",), (None,)], "k string")
    few = {1: "one", "1": "uno", "2.0": "two"}
    many = {**few, **{i: f"v{i}" for i in range(3, 60)}}
    assert H.RECODE_CASE_LIMIT < len(many)
    a, b = ([r.k for r in H.recode(df, "k", m).collect()] for m in (few, many))
    assert sorted(a, key=str) == sorted(b, key=str) == sorted(["one", "one", "two", None, None], key=str)


def test_union_filter_on_source_prunes_branch(spark):
    spec, (left, right) = O.spec(), O.sources()
    a = spark.createDataFrame([("60", "1")], "height string, blight string")
    b = spark.createDataFrame([("50", "0")], "tall string, sick string")
    u = H.combine([(a, left), (b, right)], spec).filter(F.col("source") == "south")
    plan = u._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1  # the other source was removed by the optimizer


def test_write_table_partitioned_by_source(spark, tmp_dir):
    from tabflow.sources.io import write_table
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "x int, source string")
    write_table(df, f"{tmp_dir}/t")
    assert sorted(os.listdir(f"{tmp_dir}/t"))[:2] == ["_SUCCESS", "source=a"] or \
        "source=a" in os.listdir(f"{tmp_dir}/t")
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert back.filter("source = 'a'").count() == 2
    write_table(df, f"{tmp_dir}/one.csv", fmt="csv", single_file=True)
    assert len([f for f in os.listdir(f"{tmp_dir}/one.csv") if f.startswith("part-")]) == 1


def test_checkpointed_reuses_by_fingerprint(spark, tmp_dir):
    from tabflow.sources.io import checkpointed, fingerprint
    df = spark.range(10).withColumn("y", F.col("id") * 2)
    a = checkpointed(df, f"{tmp_dir}/cache")
    b = checkpointed(df, f"{tmp_dir}/cache")
    assert a.inputFiles() == b.inputFiles() and a.count() == 10
    other = spark.range(11)
    assert fingerprint(other) != fingerprint(df)


def test_checkpointed_sees_a_rewritten_input_and_unfinished_output(spark, tmp_dir):
    from tabflow.sources.io import checkpointed
    path, cache = f"{tmp_dir}/in.csv", f"{tmp_dir}/cache"
    O.csv(tmp_dir, "in.csv", ["a"], ["1", "2"])
    assert checkpointed(read_raw(spark, path), cache).count() == 2
    O.csv(tmp_dir, "in.csv", ["a"], ["1", "2", "3"])  # in place
    assert checkpointed(read_raw(spark, path), cache).count() == 3
    half = f"{cache}/half"
    spark.range(5).write.parquet(half)
    os.remove(f"{half}/_SUCCESS")
    assert checkpointed(spark.range(7), cache, "half").count() == 7
