"""Exact tree attributions. Additivity against Spark's own outputs; equality with a brute-force
Shapley over all feature subsets of the path-dependent expectation."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import Vectors

from tabflow.plans import train as TR
from tabflow.plans import treeshap as TS


def _frame(spark, n=300):
    rnd = np.random.default_rng(3)
    X = rnd.normal(size=(n, 3))
    cat = rnd.integers(0, 2, size=n)
    y = ((X[:, 0] + 0.8 * cat - 0.5 * X[:, 2] + rnd.normal(scale=0.4, size=n)) > 0).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(c), int(k), float(t))
                                for i, ((a, b, c), k, t) in enumerate(zip(X, cat, y))],
                               "row_id long, a double, b double, c double, k int, label double")
    df = OneHotEncoder(inputCols=["k"], outputCols=["k_oh"], dropLast=True).fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "c", "k_oh"], outputCol="features").transform(df)


def _brute(trees, x, n_features):
    """Shapley values by enumerating subsets of the path-dependent expectation (Algorithm 1)."""
    def goes_left(t):
        _, f, at, cats, missing_left, _ = t
        return x[f] in cats if cats is not None else missing_left if np.isnan(x[f]) else x[f] <= at

    def expect(S):
        total = 0.0
        for leaves in trees:
            for v, U, z, tests in leaves:
                w = 1.0
                for u, f in enumerate(U):
                    if f in S:
                        w *= 1.0 if all(goes_left(t) == t[5] for t in tests if t[1] == f) else 0.0
                    else:
                        w *= z[u]
                total += v * w
        return total
    M = n_features
    phi = np.zeros(M)
    for i in range(M):
        others = [j for j in range(M) if j != i]
        for r in range(M):
            for S in itertools.combinations(others, r):
                wt = math.factorial(r) * math.factorial(M - r - 1) / math.factorial(M)
                phi[i] += wt * (expect(set(S) | {i}) - expect(set(S)))
    return phi, expect(set())


def _forest(m, spark):
    by_tree = {}
    for r in TS.node_table(m, spark).collect():
        by_tree.setdefault(r["tree"], {})[r["node"]] = r.asDict()
    return [TS.unfold(t) for t in by_tree.values()]


@pytest.mark.parametrize("name, params", [("rf", {"n_estimators": 4, "max_depth": 3}), ("gbt", {"n_estimators": 3, "max_depth": 3}),
                                          ("xgb", {"n_estimators": 3, "max_depth": 3})])
@pytest.mark.parametrize("groups", [1, 3])
def test_attributions_exact(spark, monkeypatch, name, params, groups):
    """Additive to the model's own output, equal to brute force; with several groups of trees, several
    blocks and several shares of blocks too."""
    df = _frame(spark).repartition(3).persist()
    if groups > 1:
        monkeypatch.setattr(TS, "GROUP_NODES", 14)
        monkeypatch.setattr(TS, "BLOCK_ROWS", 20)
        monkeypatch.setattr(TS, "BLOCKS_PER_TASK", 4)
    names = ["a", "b", "c", "k_0"]
    m = TR.make_estimator(name, params).fit(df)
    contrib = TS.tree_contributions(m, df, names).collect()
    assert len({(r.row_id, r.feature) for r in contrib}) == len(contrib)
    got = {}
    for r in contrib:
        got.setdefault(r.row_id, dict.fromkeys(names, 0.0))[r.feature] = r.contribution
    base, trees = TS.expected_value(m, spark), _forest(m, spark)
    out = m.transform(df).select("row_id", "probability", "rawPrediction", "features").collect()
    shift = m.base if name == "xgb" else 0.0
    for k, r in enumerate(out):
        f = r.probability[1] if name == "rf" else r.rawPrediction[1]
        mine = got.get(r.row_id, dict.fromkeys(names, 0.0))
        assert abs(base + sum(mine.values()) - f) < 1e-9, (name, r.row_id)
        if k < 15:
            want, e0 = _brute(trees, r.features.toArray(), 4)
            assert np.allclose([mine[n] for n in names], want, atol=1e-10)
            assert abs(e0 + shift - base) < 1e-10


def test_missing_values_and_long_paths(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(30, 20))
    x[rnd.random(x.shape) < 0.2] = np.nan
    # one path that tests 18 features, so patterns have no number, and one stump
    deep, node = {}, 0
    for f in range(18):
        deep[node] = {"slot": f, "at": 0.5, "cats": None, "missing_left": f % 2 == 0, "left": node + 1, "right": 100 + f,
                      "cover": 2.0 ** (18 - f), "value": 0.0}
        deep[100 + f] = {"slot": -1, "cover": 2.0 ** (17 - f), "value": 0.1 * f}
        node += 1
    deep[node] = {"slot": -1, "cover": 1.0, "value": 3.0}
    trees = [TS.unfold(deep)]
    phi = TS.attributions(x, trees, 20)
    for row, p in zip(x, phi):
        at = 0
        while deep[at]["slot"] >= 0:
            v = row[deep[at]["slot"]]
            left = deep[at]["missing_left"] if np.isnan(v) else v <= 0.5
            at = deep[at]["left"] if left else deep[at]["right"]
        expected = sum(n["value"] * n["cover"] for n in deep.values() if n["slot"] < 0) / deep[0]["cover"]
        assert abs(p.sum() + expected - deep[at]["value"]) < 1e-9
    assert (phi[:, 18:] == 0).all()


def test_no_rows(spark):
    df = _frame(spark)
    m = TR.make_estimator("rf", {"n_estimators": 2, "max_depth": 2}).fit(df)
    assert TS.tree_contributions(m, df.filter("row_id < 0"), ["a", "b", "c", "k_0"]).count() == 0
