"""Property tests: split and fold sizes per class, and search configuration."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tabflow.operators import split as SP
from tabflow.plans import train as TR


@settings(max_examples=8, deadline=None)
@given(sizes=st.lists(st.integers(min_value=1, max_value=400), min_size=1, max_size=4),
       frac=st.sampled_from([0.1, 0.2, 0.25, 0.5]), k=st.integers(min_value=2, max_value=7),
       seed=st.integers(min_value=0, max_value=10_000))
def test_split_and_fold_sizes(spark, sizes, frac, k, seed):
    rows = [(i * 1000 + j, i) for i, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = SP.stratified_split(df, "label", frac, seed, "id")
    tests = {r.label: r["count"] for r in s.filter("split = 'test'").groupBy("label").count().collect()}
    for lab, n in enumerate(sizes):
        assert abs(tests.get(lab, 0) - frac * n) <= 0.5
    f = SP.stratified_folds(df, "label", k, seed, "id").groupBy("label", "fold").count().collect()
    for lab, n in enumerate(sizes):
        counts = [r["count"] for r in f if r.label == lab]
        counts += [0] * (min(k, n) - len(counts))
        assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_search_configuration():
    ev = TR.auc_evaluator()
    assert ev.getMetricName() == "areaUnderROC" and ev.getNumBins() == 0
    lr, rf, gbt = (TR.make_estimator(n) for n in ("lr", "rf", "gbt"))
    maps = TR.param_maps("rf", rf, {"n_estimators": [100, 200], "max_depth": [None, 10],
                                    "min_samples_split": [2], "min_samples_leaf": [1, 2]})
    assert len(maps) == 8
    depths = sorted({m[rf.getParam("maxDepth")] for m in maps})
    assert depths == [10, TR.MAX_TREE_DEPTH]
    assert rf.getFeatureSubsetStrategy() == "sqrt"
    assert gbt.getLossType() == "logistic" and gbt.getMaxDepth() == 6
    assert [m[lr.getParam("C")] for m in TR.param_maps("lr", lr, {"C": [0.1, 1.0]})] == [0.1, 1.0]
    try:
        TR.param_maps("rf", rf, {"min_samples_split": [5]})
        raise AssertionError("unsupported parameter value accepted")
    except ValueError:
        pass
