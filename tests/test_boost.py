"""Second-order boosting against a plain implementation on the driver."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabflow.plans import boost as B
from tabflow.plans import train as TR


def _grow(x, g, h, rows, depth, lam, eta):
    """Greedy tree over every cut and both sides for missing values, as nested tuples."""
    G, H = g[rows].sum(), h[rows].sum()
    best = None
    for j in range(x.shape[1]) if depth else []:
        v, missing = x[rows, j], np.isnan(x[rows, j])
        for cut in [-np.inf, *np.unique(v[~missing])]:
            for side in (False, True):
                left = np.where(missing, side, v <= cut)
                gl, hl = g[rows][left].sum(), h[rows][left].sum()
                if hl < 1 or H - hl < 1:
                    continue
                gain = 0.5 * (gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam))
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, left)
    if best is None:
        return [(rows, -eta * G / (H + lam))]
    return _grow(x, g, h, rows[best[1]], depth - 1, lam, eta) + _grow(x, g, h, rows[~best[1]], depth - 1, lam, eta)


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(5)
    x = np.round(rnd.normal(size=(400, 3)), 1)
    x[rnd.random((400, 3)) < 0.1] = np.nan
    y = (np.nan_to_num(x[:, 0]) + np.isnan(x[:, 1]) + rnd.normal(scale=0.5, size=400) > 0.3).astype(float)
    df = spark.createDataFrame([(i, r.tolist(), float(t)) for i, (r, t) in enumerate(zip(x, y))], "row_id long, x array<double>, label double")
    return x, y, df.select("row_id", "label", array_to_vector("x").alias("features")).repartition(3).cache()


def test_margins_equal_a_plain_implementation(data, monkeypatch):
    monkeypatch.setattr(B, "REWRITE_ROUNDS", 2)  # stored margins and trees since then, both
    x, y, df = data
    m = B.SecondOrderTrees(maxIter=5, stepSize=0.4, maxDepth=3, regLambda=1.5, maxBins=256).fit(df)
    margin, losses = np.full(400, np.log(y.mean() / (1 - y.mean()))), []
    for _ in range(5):
        p = 1 / (1 + np.exp(-margin))
        losses.append(-np.mean(np.where(y == 1, np.log(p), np.log(1 - p))))
        for rows, value in _grow(x, p - y, p * (1 - p), np.arange(400), 3, 1.5, 0.4):
            margin[rows] += value
    got = {r["row_id"]: r["m"] for r in m.transform(df).select("row_id", _raw()[1].alias("m")).collect()}
    assert np.allclose([got[i] for i in range(400)], margin, atol=1e-9)
    assert np.allclose(m.losses, losses) and (np.diff(m.losses) < 0).all()
    assert abs(sum(m.featureImportances) - 1) < 1e-12


def _raw():
    from pyspark.ml.functions import vector_to_array
    return vector_to_array("rawPrediction")


def test_wide_levels_take_several_passes(data, monkeypatch):
    _, _, df = data
    whole = B.SecondOrderTrees(maxIter=2, maxDepth=3).fit(df)
    monkeypatch.setattr(B, "HISTOGRAM_NUMBERS", 1)
    parts = B.SecondOrderTrees(maxIter=2, maxDepth=3).fit(df)
    a, b = ([(n["slot"], n["at"], round(n["value"], 9)) for t in m._spec()["trees"] for n in t.nodes] for m in (whole, parts))
    assert a == b


def test_saved_model_and_factory(data, tmp_dir):
    _, _, df = data
    est = TR.make_estimator("xgb", {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 2, "reg_lambda": 3.0})
    m = est.copy({est.maxIter: 3}).fit(df)
    assert len(m.losses) == 3 and m.getOrDefault(m.regLambda) == 3.0
    m.write().overwrite().save(f"{tmp_dir}/m")
    again = B.SecondOrderTreesModel.load(f"{tmp_dir}/m")
    a, b = (TR.predict(x, df, ["row_id"]).orderBy("row_id").collect() for x in (m, again))
    assert a == b and {r["prediction"] for r in a} == {0, 1}
    found = TR.search("xgb", df.withColumn("fold", (F.col("row_id") % 2).cast("int")), {"n_estimators": [1, 2]}, 2)
    assert found.results.count() == 2 and found.oof.count() == 400


def test_one_class_and_no_rows(spark, data):
    _, _, df = data
    m = B.SecondOrderTrees(maxIter=1, maxDepth=2).fit(df.filter("label = 1"))
    assert m.transform(df).filter("prediction = 1").count() == 400
    with pytest.raises(ValueError, match="no labelled rows"):
        B.SecondOrderTrees(maxIter=1).fit(df.filter("label > 5"))
