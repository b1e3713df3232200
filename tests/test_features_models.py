"""Features, training, stacking, explanations, run records."""

import numpy as np
import orchards as O
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabflow.operators import split as SP
from tabflow.plans import ensemble as EN
from tabflow.plans import explain as X
from tabflow.plans import features as FE
from tabflow.plans import runlog as RL
from tabflow.plans import train as TR
from tabflow.sources import io
from tabflow.spec import FeatureSpec


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, c double")
    m = FE.ImputeScale(inputCols=["x", "c"], outputCols=["xs", "cs"]).fit(df)
    assert abs(m.getOrDefault(m.scales)[0] - 1.1180339887) < 1e-9
    assert m.getOrDefault(m.scales)[1] == 1.0


def test_imputer_nan_null_and_all_missing(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (4.0, None)],
                               "x double, z double")
    m = FE.ImputeScale(inputCols=["x", "z"], outputCols=["xs", "zs"]).fit(df)
    assert m.getInputCols() == ["x"]
    assert m.getOrDefault(m.means) == [2.5]
    out = [r.xs for r in m.transform(df).collect()]
    assert out[1] == 0.0 and out[2] == 0.0


def test_unseen_category_is_all_zeros(spark):
    spec = FeatureSpec(categorical=("c",), target="y", lineage=None)
    train = spark.createDataFrame([("b", 0), ("a", 1), ("c", 0), ("a", 1)], "c string, y int")
    test = spark.createDataFrame([("a", 0), ("zz", 1), (None, 0)], "c string, y int")
    pre = FE.fit_preprocessor(spec, train)
    assert FE.slot_names(pre, spec) == ["c_a", "c_b", "c_c"]
    got = [list(r.features.toArray()) for r in pre.transform(test).collect()]
    assert got == [[1, 0, 0], [0, 0, 0], [0, 0, 0]]


def test_binary_nan_counts_as_zero(spark):
    spec = FeatureSpec(binary=("b",), target="y", lineage=None)
    df = spark.createDataFrame([(float("nan"), 0), (1.0, 1), (None, 0)], "b double, y int")
    assert [list(r.features.toArray()) for r in FE.fit_preprocessor(spec, df).transform(df).collect()] == [[0.0], [1.0], [0.0]]


def test_model_schema_widths(spark):
    spec = O.spec()
    s = SP.stratified_split(O.frame(spark), "blight", 0.2, 42, "plot")
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    pre = FE.fit_preprocessor(spec, train)
    w_train = len(pre.transform(train).first().features)
    w_test = len(pre.transform(test).first().features)
    assert w_train == w_test == len(FE.slot_names(pre, spec)) == 3 + 3 + 3 + 1


def _newton_lr(X, y, C, penalize_intercept):
    Xa = np.hstack([X, np.ones((len(X), 1))])
    w = np.zeros(Xa.shape[1])
    pen = np.ones(Xa.shape[1]) / C
    if not penalize_intercept:
        pen[-1] = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-Xa @ w))
        g = Xa.T @ (p - y) + pen * w
        H = Xa.T @ (Xa * (p * (1 - p))[:, None]) + np.diag(pen)
        w -= np.linalg.solve(H, g)
    return w


def test_penalized_logit_matches_newton(spark):
    rnd = np.random.default_rng(0)
    X = rnd.normal(size=(500, 3))
    y = (X @ [1.0, -2.0, 0.5] + 0.7 + rnd.logistic(size=500) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(x), float(t)) for x, t in zip(X, y)], ["features", "label"])
    for pen in (False, True):
        m = TR.PenalizedLogit(C=0.1, penalizeIntercept=pen, tol=1e-10).fit(df)
        want = _newton_lr(X, y, 0.1, pen)
        if pen:
            got = m.stages[-1].coefficients.toArray()
        else:
            got = np.append(m.coefficients.toArray(), m.intercept)
        assert np.allclose(got, want, atol=1e-5), (pen, got, want)


def test_grid_sizes_and_sampling():
    est = {n: TR.make_estimator(n) for n in ("lr", "rf", "gbt")}
    from tabflow.plans.workflow import DEFAULT_GRIDS
    sizes = {g.model: len(TR.param_maps(g.model, est[g.model], g.grid)) for g in DEFAULT_GRIDS}
    assert sizes == {"lr": 11, "rf": 9, "gbt": 9}
    maps = TR.param_maps("lr", est["lr"], {"C": list(range(1, 31))})
    assert len(TR.sample_grid(maps, 20, 42)) == 20
    assert TR.sample_grid(maps, 20, 42) == TR.sample_grid(maps, 20, 42)
    try:
        TR.make_estimator("svm")
        raise AssertionError("unknown family accepted")
    except ValueError:
        pass


def _vec_frame(spark, n=240):
    rnd = np.random.default_rng(1)
    X = rnd.normal(size=(n, 4))
    y = (X[:, 0] - X[:, 1] + rnd.normal(scale=0.5, size=n) > 0).astype(float)
    df = spark.createDataFrame([(i, Vectors.dense(x), float(t)) for i, (x, t) in enumerate(zip(X, y))],
                               ["row_id", "features", "label"])
    return SP.stratified_folds(df, "label", 3, 42, "row_id")


def test_oof_scores_each_row_once_and_stack_width(spark):
    df = _vec_frame(spark).persist()
    est = {"lr": TR.make_estimator("lr"), "rf": TR.make_estimator("rf", {"n_estimators": 5, "max_depth": 3}),
           "gbt": TR.make_estimator("gbt", {"n_estimators": 5})}
    oof = EN.oof_scores(est, df, 3)
    per = oof.groupBy("model", "row_id").count()
    assert per.filter("count != 1").count() == 0 and per.count() == 3 * df.count()
    x = EN.stack_input(oof, list(est))
    assert len(x.first().features) == 3
    meta, base, stacked = EN.run_stack({"lr": est["lr"], "rf": est["rf"]}, df, df.drop("fold"), 3)
    assert stacked.count() == df.count()


def test_search_and_cv_score(spark):
    df = _vec_frame(spark).persist()
    sr = TR.search("lr", df, {"C": [0.01, 1.0]}, k=3)
    rows = sr.results.collect()
    assert len(rows) == 2 and sum(r.is_best for r in rows) == 1
    # the one-job grouped AUCs equal Spark's CrossValidator + exact evaluator on the same folds
    mean, std = TR.cv_score(sr.best_estimator, df, 3)
    best_row = [r for r in rows if r.is_best][0]
    assert abs(mean - best_row.mean_auc) < 1e-9 and abs(std - best_row.std_auc) < 1e-9
    oof = sr.oof.groupBy("row_id").count()
    assert oof.count() == df.count() and oof.filter("count != 1").count() == 0


def test_save_load_same_scores(spark, tmp_dir):
    from pyspark.ml import PipelineModel
    df = _vec_frame(spark)
    m = PipelineModel(stages=[TR.make_estimator("lr").fit(df)])
    io.save_model(m, df, f"{tmp_dir}/lr")
    again = io.load_model(f"{tmp_dir}/lr")
    a = [r.score for r in TR.positive_score(m.transform(df)).orderBy("row_id").collect()]
    b = [r.score for r in TR.positive_score(again.transform(df)).orderBy("row_id").collect()]
    assert a == b
    assert spark.read.parquet(f"{tmp_dir}/lr/input_example").count() == 5


def test_linear_contributions_additive(spark):
    df = _vec_frame(spark)
    m = TR.make_estimator("lr").fit(df)
    names = ["a", "b", "c", "d"]
    means = X.feature_means(df)
    contrib = X.linear_contributions(df, m.coefficients.toArray(), means, names, "row_id")
    sums = {r.row_id: r.s for r in contrib.groupBy("row_id").agg(F.sum("contribution").alias("s")).collect()}
    coef = m.coefficients.toArray()
    base = float(np.dot(coef, means)) + m.intercept
    for r in m.transform(df).select("row_id", "rawPrediction").collect():
        assert abs(sums[r.row_id] + base - r.rawPrediction[1]) < 1e-9


def test_append_run_twice(spark, tmp_dir):
    timer = RL.StageTimer()
    with timer.stage("x"):
        pass
    ev = spark.createDataFrame([("lr", 0.9, 0.8, 0.7, 0.75, 0.85)],
                               "model string, accuracy double, precision double, recall double, f1 double, roc_auc double")
    long = RL.metrics_long(ev, "r1")
    rec = RL.run_record(spark, long, "r1", "local", timer, {"lr_best_params": "{'C': 1.0}"})
    RL.append_records(rec, long, tmp_dir)
    RL.append_records(rec, long, tmp_dir)
    runs = spark.read.parquet(f"{tmp_dir}/runs")
    assert runs.count() == 2
    row = runs.first()
    assert row.metrics["lr_test_roc_auc"] == 0.85 and row.params["lr_best_params"] == "{'C': 1.0}"


def test_workflow_end_to_end(spark, tmp_dir):
    from tabflow.plans import workflow as WF
    from tabflow.spec import GridSpec, SourceSpec, StackSpec
    df = O.frame(spark, n=160, seed=11)
    spec = O.spec()
    grids = (GridSpec("lr", {"C": [0.1, 1.0]}), GridSpec("rf", {"n_estimators": [5], "max_depth": [3]}))
    res = WF.run(spark, [(df, SourceSpec(name="north"))], spec, grids=grids, k=3,
                 stack=StackSpec(base=("lr", "rf")), out_dir=tmp_dir, profile=True)
    models = {r.model for r in res.metrics.collect()}
    assert models == {"lr", "rf", "lr_train", "rf_train", "stacked"}
    cv = {r.model: r.cv_mean_auc for r in res.cv.collect()}
    assert set(cv) == {"lr", "rf", "stacked"} and all(0 <= v <= 1 for v in cv.values())
    rec = spark.read.parquet(f"{tmp_dir}/runs").collect()
    assert len(rec) == 1 and "stacked_test_roc_auc" in rec[0].metrics
    assert "lr_best_params" in rec[0].params and rec[0].total_runtime_seconds > 0
    long = spark.read.parquet(f"{tmp_dir}/metrics")
    assert {r.name for r in long.filter("kind = 'cv' AND model = 'stacked'").collect()} == {"mean_roc_auc", "std_roc_auc"}
    assert {r.kind for r in long.filter("model = 'lr'").collect()} == {"test", "train", "cv", "param"}
    assert "lr_cv_std_roc_auc" in rec[0].metrics and "rf_train_roc_auc" in rec[0].metrics
    assert len(list((__import__("pathlib").Path(tmp_dir) / "models").iterdir())) == 4
    assert res.explanations["rf_attributions"].count() > 0
    assert res.profiles["describe"].count() == len(spec.numeric)
