"""The batched logistic search and preprocessing inside folds, against one fit at a time."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabflow.plans import ensemble as EN
from tabflow.plans import features as FE
from tabflow.plans import logit_grid as LG
from tabflow.plans import train as TR
from tabflow.plans.metrics import roc_auc
from tabflow.spec import FeatureSpec

SPEC = FeatureSpec(numeric=("height", "weight", "empty"), categorical=("kind", "third"), binary=("wet",), target="label", key=("row_id",))


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(7)
    data = []
    for i in range(600):
        h, w = float(rnd.normal(10, 4)), float(rnd.normal(-2, 1))
        kind = "only1" if i % 4 == 1 and i % 3 == 0 else ["a", "b", None][int(rnd.integers(3))]
        p = 1 / (1 + np.exp(-(0.3 * (h - 10) + w + 2 + (kind == "a"))))
        data.append((i, float(rnd.random() < p), i % 4, None if i % 7 == 0 else h, float("nan") if i % 11 == 0 else w,
                     None if i % 4 != 3 else 2.5, kind, f"t{i % 3}" if i % 5 else "t9", float(i % 2)))
    return spark.createDataFrame(data, "row_id long, label double, fold int, height double, weight double, empty double, "
                                       "kind string, third string, wet double").cache()


@pytest.fixture(scope="module")
def dense(rows):
    x = rows.na.fill(0.0, ["height", "weight"]).withColumn("h", F.nanvl("height", F.lit(0.0)) / 10).withColumn("w", F.nanvl("weight", F.lit(0.0)))
    return VectorAssembler(inputCols=["h", "w", "wet"], outputCol="features").transform(x).select("row_id", "label", "fold", "features").cache()


def test_every_pair_equals_its_own_fit(dense):
    Cs = [0.01, 1.0, 50000.0]
    grid = LG.fit_grid(dense, Cs, 4, all_rows=True)
    assert grid.converged.all()
    for c, C in enumerate(Cs):
        for f in (0, 3, 4):
            one = TR.PenalizedLogit(C=C, tol=1e-13).fit(dense.filter(F.col("fold") != f))
            assert np.allclose(grid.weights[c, f], [one.intercept, *one.coefficients], atol=1e-6)


def test_as_many_passes_as_the_slowest_pair(dense):
    Cs = [0.0001, 0.1, 100.0]
    alone = [LG.fit_grid(dense.filter(F.col("fold") != f).withColumn("fold", F.lit(9)), [C], 1).passes
             for C in Cs for f in range(4)]
    assert LG.fit_grid(dense, Cs, 4).passes == max(alone)


def test_separable_rows_still_converge(spark):
    df = spark.createDataFrame([(float(i), float(i >= 20), i % 2) for i in range(40)], "x double, label double, fold int")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    grid = LG.fit_grid(df, [1.0, 50000.0], 2)
    assert grid.converged.all() and (grid.weights[:, :, 1] > 0).all()


def test_rows_without_label_or_of_one_class(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (2.0, None, 0), (3.0, 1.0, 1)], "x double, label double, fold int")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    assert LG.held_out_scores(df, LG.fit_grid(df, [1.0], 2, max_passes=5), []).count() == 2
    with pytest.raises(ValueError, match="no labelled rows"):
        LG.fit_grid(df.limit(0), [1.0], 2)


def _vectors(model, df):
    return {r["row_id"]: r["features"].toArray() for r in model.transform(df).select("row_id", "features").collect()}


@pytest.mark.parametrize("left_out", [0, 1, 3, (1, 3), None])
def test_fold_model_equals_refitting(rows, left_out):
    folds = FE.fold_features(SPEC, rows, "fold", 4)
    gone = [left_out] if isinstance(left_out, int) else list(left_out or ())
    refit = FE.fit_preprocessor(SPEC, rows.filter(~F.col("fold").isin(gone)) if gone else rows)
    got, want = _vectors(folds.model(left_out), rows), _vectors(refit, rows)
    assert all(np.allclose(got[i], want[i], atol=1e-9) for i in want)
    assert FE.slot_names(folds.model(left_out), SPEC) == FE.slot_names(refit, SPEC)


def test_one_aggregate_for_all_folds(spark, rows):
    tracker, group = spark.sparkContext.statusTracker(), "fold-statistics"
    spark.sparkContext.setJobGroup(group, group)
    folds = FE.fold_features(SPEC, rows, "fold", 4)
    models = [folds.model(f) for f in (0, 1, 2, 3, None)]
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(models) == 5 and len(jobs) <= 2  # the aggregate's shuffle and result, no job per fold


def test_grid_with_fold_statistics_equals_refitting(rows):
    folds = FE.fold_features(SPEC, rows, "fold", 4)
    grid = LG.fit_grid(folds.raw(rows), [0.5], 4, shifts=folds.affine()[0], scales=folds.affine()[1])
    scores = {r["row_id"]: r["score"] for r in LG.held_out_scores(folds.raw(rows), grid, ["row_id"]).collect()}
    for f in range(4):
        pre = FE.fit_preprocessor(SPEC, rows.filter(F.col("fold") != f))
        model = TR.PenalizedLogit(C=0.5, tol=1e-13).fit(pre.transform(rows.filter(F.col("fold") != f)))
        for r in TR.positive_score(model.transform(pre.transform(rows.filter(F.col("fold") == f)))).collect():
            assert abs(scores[r["row_id"]] - r["score"]) < 1e-6


def test_search_takes_the_grid_and_folds(rows):
    folds = FE.fold_features(SPEC, rows, "fold", 4)
    ready = folds.model(None).transform(rows).select("row_id", "label", "fold", "features")
    found = TR.search("lr", ready, {"C": [0.001, 1.0]}, 4, folds=folds, raw=rows)
    slow = TR.search("lr", rows, {"C": [0.001, 1.0]}, 4, preprocessor=FE.build_preprocessor(
        FeatureSpec(numeric=("height", "weight"), categorical=("kind", "third"), binary=("wet",), target="label", key=("row_id",))))
    got, want = ([r["mean_auc"] for r in s.results.orderBy("mean_auc").collect()] for s in (found, slow))
    assert found.oof.count() == 600 and found.oof.select("row_id").distinct().count() == 600
    assert np.allclose(got, want, atol=0.02)  # the slow way lacks the column that one fold has no values of
    trees = TR.search("rf", ready, {"n_estimators": [3], "max_depth": [3]}, 4, folds=folds, raw=rows)
    assert trees.oof.count() == 600


def test_cv_scores_of_several_models(dense):
    models = {"a": TR.PenalizedLogit(C=0.1), "b": TR.PenalizedLogit(C=10.0)}
    got = TR.cv_scores(models, dense, 4)
    for n, m in models.items():
        assert np.allclose(got[n], TR.cv_score(m, dense, 4), atol=1e-9)


def test_shared_fits_of_the_nested_stack(dense):
    models = {"a": TR.PenalizedLogit(C=0.01), "b": TR.make_estimator("rf", {"n_estimators": 3, "max_depth": 3})}
    mean, std = EN.nested_stack_cv(models, dense, 4)
    aucs = []
    for i in range(4):  # the same by hand: inner folds are the other folds
        rest, held = dense.filter(F.col("fold") != i), dense.filter(F.col("fold") == i)
        parts = [TR.positive_score(m.fit(rest.filter(F.col("fold") != j)).transform(rest.filter(F.col("fold") == j)))
                 .select("row_id", F.col("label").cast("int").alias("label"), F.lit(n).alias("model"), "score")
                 for n, m in models.items() for j in range(4) if j != i]
        oof = parts[0]
        for p in parts[1:]:
            oof = oof.unionByName(p)
        meta = EN.fit_stack(oof, list(models))
        scored = EN.stacked_scores(meta, {n: m.fit(rest) for n, m in models.items()}, held)
        aucs.append(roc_auc(scored).first()["roc_auc"])
    assert abs(mean - np.mean(aucs)) < 1e-6 and abs(std - np.std(aucs)) < 1e-6


def test_block_sums_take_one_exponential(monkeypatch):
    rnd = np.random.default_rng(4)
    n = LG.BLOCK_ROWS
    x, y, fold = rnd.normal(size=(n, 2)) * 30, (rnd.random(n) < 0.5) * 1.0, rnd.integers(0, 3, n)
    w, folds_of = rnd.normal(size=(6, 3)), np.tile(np.arange(3), 2)
    calls, exp = [], np.exp
    out = np.zeros((6, 1 + 3 + 6))
    with monkeypatch.context() as m:
        m.setattr(LG.np, "exp", lambda *a, **b: calls.append(1) or exp(*a, **b))
        LG._block_sums(x, y, fold, folds_of, w, None, None, out)
    assert len(calls) == 1
    z = np.c_[np.ones(n), x]
    for p in range(6):
        seen = fold != folds_of[p]
        margin = z[seen] @ w[p]
        prob = 1 / (1 + np.exp(-margin))
        assert out[p, 0] == pytest.approx(np.sum(np.logaddexp(0, margin) - y[seen] * margin), rel=1e-12)
        assert out[p, 1:4] == pytest.approx((prob - y[seen]) @ z[seen], rel=1e-9, abs=1e-9)
        assert out[p, 4:] == pytest.approx((z[seen].T * prob * (1 - prob) @ z[seen])[np.triu_indices(3)], rel=1e-9, abs=1e-9)
