import math
import random

import numpy as np
from pyspark.sql import functions as F

from tabflow.operators import profile as P


def test_histogram_numpy_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 5)], "x double")
    h = P.histogram(df, ["x"], bins=5).orderBy("bin").collect()
    assert [r.n for r in h] == [1, 1, 1, 1, 1]
    counts, _ = np.histogram([0, 1, 2, 3, 5], bins=5)
    assert list(counts) == [r.n for r in h]


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h = P.histogram(df, ["x"], bins=15).collect()
    assert sum(r.n for r in h) == 2
    assert abs(h[0].lo - 1.5) < 1e-12 or h[0].lo <= 2.0 <= h[0].hi


def test_exact_quantiles_small_buckets_match_numpy(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([1.0, 2.0, 2.0, 3.5]) if i % 3 == 0 else rnd.gauss(0, 10) for i in range(3000)]
    vals += [None] * 50 + [float("nan")] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs, _ = P.exact_quantiles(df, ["x"], (0.1, 0.25, 0.5, 0.75, 0.9), n_buckets=8)
    clean = [v for v in vals if v is not None and not math.isnan(v)]
    want = np.quantile(clean, [0.1, 0.25, 0.5, 0.75, 0.9])
    assert np.allclose(qs["x"], want, rtol=0, atol=1e-9)


def test_exact_quantiles_hot_value(spark):
    # a third of the rows share one value: its bucket resolves without a window
    vals = [7.0] * 1000 + [float(i) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs, _ = P.exact_quantiles(df, ["x"], (0.25, 0.5, 0.75), n_buckets=16)
    assert np.allclose(qs["x"], np.quantile(vals, [0.25, 0.5, 0.75]))


def test_describe_approx_error_bound(spark):
    df = spark.range(0, 10000).select(F.col("id").cast("double").alias("x"))
    row = P.describe_approx(df, ["x"], accuracy=1000).collect()[0]
    assert abs(row.p50 - 4999.5) <= 10000 / 1000 + 1
    assert row["count"] == 10000


def test_null_counts_count_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b")], "x double, s string")
    got = {r.column_name: r.n_null for r in P.null_counts(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_value_counts_ratio(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "y int")
    got = {r.y: (r.n, r.ratio) for r in P.value_counts(df, "y").collect()}
    assert got == {0: (2, 2 / 3), 1: (1, 1 / 3)}


def test_schema_info(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None)], "x double, s string")
    got = {r.column_name: (r.type, r.non_null) for r in P.schema_info(df).collect()}
    assert got == {"x": ("double", 1), "s": ("string", 1)}


def test_exact_quantiles_refined_ranges(spark, monkeypatch):
    # a tiny window bound forces several range splits: equal-width first, then sketch points;
    # values span many orders of magnitude, with a hot value and near-equal neighbours
    monkeypatch.setattr(P, "WINDOW_MAX_ROWS", 40)
    monkeypatch.setattr(P, "EQUAL_WIDTH_LEVELS", 2)
    rnd = random.Random(11)
    vals = [10.0 ** rnd.uniform(-30, 30) * rnd.choice([-1, 1]) for _ in range(3000)]
    vals += [5.0] * 1500 + [5.0 + 1e-12 * i for i in range(1, 30)] + [-1e300, 1e300]
    df = spark.createDataFrame([(v, v / 3) for v in vals], "x double, y double")
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0)
    qs, _ = P.exact_quantiles(df, ["x", "y"], probs, n_buckets=8)
    for c, data in (("x", vals), ("y", [v / 3 for v in vals])):
        want = np.quantile(data, probs)
        assert np.allclose(qs[c], want, rtol=1e-12, atol=0), (c, qs[c], want)


def test_describe_approx_moments_and_empty_columns(spark):
    import numpy as np
    from pyspark.sql import functions as F
    rnd = np.random.default_rng(2)
    x = rnd.normal(1e9, 1.0, size=5000)
    df = spark.createDataFrame([(float(v), None, float(i) if i == 7 else None) for i, v in enumerate(x)],
                               "x double, none double, one double").repartition(9)
    got = {r["column_name"]: r for r in P.describe_approx(df, ["x", "none", "one"]).collect()}
    assert abs(got["x"]["mean"] - x.mean()) < 1e-6 and abs(got["x"]["std"] - x.std(ddof=1)) < 1e-6
    assert got["x"]["count"] == 5000 and got["x"]["min"] == x.min() and got["x"]["max"] == x.max()
    assert got["none"]["count"] == 0 and got["none"]["p50"] is None and got["none"]["std"] is None
    assert got["one"]["p25"] == got["one"]["max"] == 7.0 and got["one"]["std"] is None
    plan = P.describe_approx(df, ["x"])._jdf.queryExecution().toString()
    assert "Expand" not in plan and "percentile_approx" not in plan
    assert P.describe_approx(df.filter(F.lit(False)), ["x"]).first()["count"] == 0


def test_range_splits_on_crowded_values(spark, monkeypatch):
    """Scores crowded in a tiny range, very large ones and few: buckets stay small, and the AUC exact."""
    import numpy as np
    from pyspark.sql import functions as F

    from tabflow.functions import ranks
    from tabflow.plans import metrics as M
    monkeypatch.setattr(ranks, "MAX_ROWS_PER_BUCKET", 200)
    rnd = np.random.default_rng(4)
    score = np.concatenate([rnd.random(4000) * 1e-12, rnd.random(1000), [1e308, -1e308, 5.0]])
    label = (rnd.random(len(score)) < 0.3 + 0.4 * (score > 5e-13)).astype(int)
    df = spark.createDataFrame([("m", float(s), int(t)) for s, t in zip(score, label)] + [("few", 0.5, 1), ("few", 0.25, 0)],
                               "model string, score double, label int")
    splits = ranks.range_splits(df, "model", "score")
    held = ranks.with_bucket(df, "model", "score", splits).groupBy("model", "_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("score").alias("d")).collect()
    assert max(r["n"] for r in held) <= 200 and sum(r["n"] for r in held) == df.count()
    pos, neg = score[label == 1], score[label == 0]
    want = ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)
    got = {r["model"]: r["roc_auc"] for r in M.roc_auc(df).collect()}
    assert abs(got["m"] - want) < 1e-12 and got["few"] == 1.0
