"""Model training and selection with Spark ML.

Every fit is a distributed Spark ML job on a cached, fold-tagged frame; the driver holds only
parameter maps, metrics and fitted models. Search fits every candidate on every fold of an explicit fold
column, so the folds are the hash-placed, stratified ones of ``split.stratified_folds`` and the
same for every candidate and every model family; the final score of a chosen model uses
``CrossValidator`` on such a column.
"""

from __future__ import annotations

import random
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol,
                                     HasProbabilityCol, HasRawPredictionCol, HasTol, Param, Params,
                                     TypeConverters)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.plans import logit_grid
from tabflow.plans.boost import SecondOrderTrees

MAX_TREE_DEPTH = 30  # Spark's limit; an "unlimited" depth becomes this


class PenalizedLogit(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol,
                     HasRawPredictionCol, HasMaxIter, HasTol, DefaultParamsReadable,
                     DefaultParamsWritable):
    """M1: L2 logistic regression parametrised by the inverse strength ``C``.

    The objective ``C·Σ loss + ½‖w‖²`` divided by ``C·n`` is Spark's ``(1/n)·Σ loss + λ/2·‖w‖²``
    with ``λ = 1/(C·n)``; ``n`` is counted at fit time, so every fold and the refit get the
    strength that matches their own size. Features are used as given (no internal
    standardisation). By default the intercept is not penalised; ``penalizeIntercept=True`` fits
    the objective that penalises it too, through the mirrored-row construction below.
    """

    C = Param(Params._dummy(), "C", "inverse regularisation strength", TypeConverters.toFloat)
    penalizeIntercept = Param(Params._dummy(), "penalizeIntercept",
                              "penalise the intercept like a weight", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, C=1.0, featuresCol="features", labelCol="label", predictionCol="prediction",
                 probabilityCol="probability", rawPredictionCol="rawPrediction", maxIter=1000,
                 tol=1e-4, penalizeIntercept=False):
        super().__init__()
        # tol 1e-4 and maxIter 1000: the original solver's defaults as it was configured
        self._setDefault(C=1.0, maxIter=1000, tol=1e-4, penalizeIntercept=False)
        self._set(**self._input_kwargs)

    def setC(self, v):
        return self._set(C=v)

    def _lr(self, reg: float, fit_intercept: bool, features: str) -> LogisticRegression:
        return LogisticRegression(
            featuresCol=features, labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
            probabilityCol=self.getProbabilityCol(), rawPredictionCol=self.getRawPredictionCol(),
            maxIter=self.getMaxIter(), tol=self.getTol(), regParam=reg, elasticNetParam=0.0,
            standardization=False, fitIntercept=fit_intercept, family="binomial")

    def _fit(self, dataset: DataFrame):
        n = dataset.count()
        reg = 1.0 / (self.getOrDefault(self.C) * max(n, 1))
        if not self.getOrDefault(self.penalizeIntercept):
            return self._lr(reg, True, self.getFeaturesCol()).fit(dataset)
        # A constant-1 feature is left unfitted by Spark's optimiser, so instead: append 1 to x and
        # add a mirrored row (-x, -1, 1-y) per row. With no intercept the fit on the doubled data at
        # λ = 1/(C·n), n the original count, minimises the objective whose intercept (the last
        # weight) is penalised.
        aug = "_features_aug"
        add_one = SQLTransformer(statement="SELECT *, 1D AS _one FROM __THIS__")
        assemble = VectorAssembler(inputCols=[self.getFeaturesCol(), "_one"], outputCol=aug)
        base = assemble.transform(add_one.transform(dataset))
        mirrored = base.withColumn(aug, array_to_vector(F.transform(vector_to_array(aug), lambda v: -v))) \
                       .withColumn(self.getLabelCol(), 1.0 - F.col(self.getLabelCol()))
        lr = self._lr(reg, False, aug).fit(base.unionByName(mirrored))
        return PipelineModel(stages=[add_one, assemble, lr])


def _rf(params: dict, seed: int, label: str, features: str) -> RandomForestClassifier:
    depth = params.get("max_depth")
    split = params.get("min_samples_split", 2)
    if split not in (2, None):
        raise ValueError("min_samples_split other than 2 has no Spark equivalent")
    return RandomForestClassifier(
        labelCol=label, featuresCol=features, numTrees=int(params.get("n_estimators", 100)),
        maxDepth=MAX_TREE_DEPTH if depth is None else min(int(depth), MAX_TREE_DEPTH),
        minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        featureSubsetStrategy="sqrt", seed=seed)


def _gbt(params: dict, seed: int, label: str, features: str) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features,
                         maxIter=int(params.get("n_estimators", 100)),
                         stepSize=float(params.get("learning_rate", 0.1)),
                         maxDepth=int(params.get("max_depth", 6)), lossType="logistic", seed=seed)


def make_estimator(name: str, params: dict | None = None, seed: int = 42, label: str = "label",
                   features: str = "features"):
    """Model factory by family name: 'lr', 'rf', 'gbt' (Spark's first-order boosting), 'xgb' (second-order
    boosting with L2 leaf weights, ``boost``); unknown names are an error.
    Parameter names follow the original workflow's (C, n_estimators, max_depth, ...)."""
    params = dict(params or {})
    if name == "lr":
        return PenalizedLogit(C=float(params.get("C", 1.0)), labelCol=label, featuresCol=features,
                              maxIter=int(params.get("max_iter", 1000)))
    if name == "rf":
        return _rf(params, seed, label, features)
    if name == "gbt":
        return _gbt(params, seed, label, features)
    if name == "xgb":
        return SecondOrderTrees(labelCol=label, featuresCol=features, maxIter=int(params.get("n_estimators", 100)),
                                stepSize=float(params.get("learning_rate", 0.1)), maxDepth=int(params.get("max_depth", 6)),
                                regLambda=float(params.get("reg_lambda", 1.0)), minSplitGain=float(params.get("gamma", 0.0)),
                                minChildWeight=float(params.get("min_child_weight", 1.0)))
    raise ValueError(f"unknown model family {name!r}")


# Spark parameter behind each original parameter name, per family.
_PARAM_NAMES = {
    "lr": {"C": "C", "max_iter": "maxIter"},
    "rf": {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"},
    "gbt": {"n_estimators": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth"},
}
_PARAM_NAMES["xgb"] = _PARAM_NAMES["gbt"] | {"reg_lambda": "regLambda", "gamma": "minSplitGain", "min_child_weight": "minChildWeight"}


def param_maps(name: str, estimator, grid: dict[str, list]) -> list[dict]:
    """The full grid as Spark param maps (an exhaustive search's candidates)."""
    builder = ParamGridBuilder()
    for k, values in grid.items():
        if k == "min_samples_split":
            if any(v not in (2, None) for v in values):
                raise ValueError("min_samples_split other than 2 has no Spark equivalent")
            continue
        spark_name = _PARAM_NAMES[name].get(k)
        if spark_name is None:
            raise ValueError(f"unknown parameter {k!r} for {name}")
        if spark_name == "maxDepth":
            values = [MAX_TREE_DEPTH if v is None else min(int(v), MAX_TREE_DEPTH) for v in values]
        builder = builder.addGrid(estimator.getParam(spark_name), list(values))
    return builder.build()


def sample_grid(maps: list[dict], n_iter: int | None, seed: int = 42) -> list[dict]:
    """M6: random search = a seeded sample of the grid without replacement; the whole grid when
    it is not larger than ``n_iter``."""
    if n_iter is None or len(maps) <= n_iter:
        return list(maps)
    return random.Random(seed).sample(list(maps), n_iter)


def auc_evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    """Exact ROC AUC (``numBins=0``: no down-sampling of the ROC curve, ties averaged)."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0)


def _describe_map(pm: dict) -> dict:
    return {p.name: str(v) for p, v in pm.items()}


@dataclass
class SearchResult:
    """Outcome of one family's search: the best candidate refitted on all rows, every
    candidate's fold metrics, the best unfitted estimator, and the best candidate's out-of-fold
    scores ``(row_id, label, model, score, fold)`` (each row scored once, by the model that did
    not see it), which stacking reuses instead of refitting."""

    best_model: object
    results: DataFrame
    best_estimator: object
    oof: DataFrame


def _mean_std(values: Iterable[float | None]) -> tuple[float, float]:
    """Mean and population std of the AUCs that exist."""
    kept = [v for v in values if v is not None]
    if not kept:
        return float("nan"), float("nan")
    m = sum(kept) / len(kept)
    return m, (sum((v - m) ** 2 for v in kept) / len(kept)) ** 0.5


def _grid_of_strengths(name: str, maps: list[dict], width: int) -> list[float] | None:
    """The candidates' C when they differ in nothing else and Hessians can be formed; else None."""
    if name != "lr" or width > logit_grid.MAX_SLOTS or any({p.name for p in pm} != {"C"} for pm in maps):
        return None
    return [float(v) for pm in maps for v in pm.values()]


def search(name: str, df: DataFrame, grid: dict[str, list], k: int, fold_col: str = "fold",
           label: str = "label", features: str = "features", n_iter: int | None = None,
           seed: int = 42, parallelism: int = 4, preprocessor: Pipeline | None = None,
           row_id: str = "row_id", folds=None, raw: DataFrame | None = None) -> SearchResult:
    """Search one family by cross-validated AUC over fixed stratified folds.

    ``df`` carries a ready ``features`` column, on which the best candidate (highest mean AUC) is
    refitted. With ``folds`` (``features.fold_features`` of the same rows) and ``raw``, the rows with
    their columns, every fold's fits use the preprocessor fitted without that fold, so nothing leaks
    into it. ``preprocessor`` is the general, slower way: any pipeline, refitted with every fit.

    Logistic candidates that differ in C only are fitted all together (``logit_grid``): a data pass
    per iteration for the whole grid, and one more for all held-out scores. Other families fit every
    (candidate, fold) on its own, ``parallelism`` fits submitted at once. Every (candidate, fold) AUC
    comes from one grouped exact-AUC job, and only the winner's held-out scores (one per row) are
    stored, for stacking.
    """
    from concurrent.futures import ThreadPoolExecutor

    from tabflow.plans.metrics import roc_auc
    from tabflow.sources.io import materialize

    est = make_estimator(name, {}, seed, label, features)
    maps = sample_grid(param_maps(name, est, grid), n_iter, seed)
    target = Pipeline(stages=[preprocessor, est]) if preprocessor is not None else est
    n_cand = len(maps)
    shifts = scales = None
    if folds is not None:
        shifts, scales = folds.affine()
        width = shifts.shape[1]
    else:
        first = df.select(features).first() if preprocessor is None else None
        width = len(first[0]) if first is not None else logit_grid.MAX_SLOTS + 1
    strengths = _grid_of_strengths(name, maps, width)

    if strengths is not None:
        rows = df if folds is None else folds.raw(raw, features).select(row_id, label, fold_col, features)
        fitted = logit_grid.fit_grid(rows, strengths, k, fold_col, label, features, shifts, scales)

        def held_out(candidates=None) -> DataFrame:
            scored = logit_grid.held_out_scores(rows, fitted, [row_id], fold_col, label, features, candidates)
            return scored.select(row_id, "label", (F.col("candidate") * k + F.col(fold_col)).alias("_cf"), "score")
    else:
        seen = df if raw is None or folds is None else raw

        def fold_scores(task):
            i, j = task
            frame = seen if folds is None else folds.model(i, features).transform(seen)
            model = target.copy(maps[j]).fit(frame.filter(F.col(fold_col) != i))
            scored = positive_score(model.transform(frame.filter(F.col(fold_col) == i)))
            return scored.select(row_id, F.col(label).cast("int").alias("label"),
                                 F.lit(j * k + i).alias("_cf"), "score")

        tasks = [(i, j) for i in range(k) for j in range(n_cand)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            parts = list(pool.map(fold_scores, tasks))

        def held_out(candidates=None) -> DataFrame:
            chosen = [p for (_, j), p in zip(tasks, parts, strict=True) if candidates is None or j in candidates]
            return reduce(lambda a, b: a.unionByName(b), chosen)

    # roc_auc writes its distinct-score table once, so every fold model scores its rows once;
    # the candidates' validation scores themselves are never stored
    aucs = {r["_cf"]: r["roc_auc"] for r in roc_auc(held_out(), model="_cf").collect()}
    folded = [_mean_std(aucs.get(j * k + i) for i in range(k)) for j in range(n_cand)]
    best = max(range(n_cand), key=lambda j: (folded[j][0], -j))
    rows_out = [(name, _describe_map(pm), *folded[j], j == best) for j, pm in enumerate(maps)]
    results = df.sparkSession.createDataFrame(
        rows_out, "model string, params map<string,string>, mean_auc double, std_auc double, is_best boolean")
    best_est = target.copy(maps[best])
    # only the winner's held-out scores are kept: N rows, reused by stacking
    oof = materialize(held_out([best]).select(row_id, "label", F.lit(name).alias("model"), "score",
                                              (F.col("_cf") - best * k).cast("int").alias(fold_col)), f"oof-{name}")
    return SearchResult(best_est.fit(df), results, best_est, oof)


def cv_scores(estimators: dict, df: DataFrame, k: int, fold_col: str = "fold", label: str = "label",
              row_id: str = "row_id", parallelism: int = 4, folds=None, features: str = "features") -> dict:
    """M7: mean and population std of the fold AUCs of fixed estimators, by name. Fits are submitted
    ``parallelism`` at a time and all AUCs come from one grouped job. With ``folds`` the rows of
    ``df`` are preprocessed inside every fold."""
    from concurrent.futures import ThreadPoolExecutor

    from tabflow.plans.metrics import roc_auc

    names = list(estimators)

    def one(task):
        at, i = task
        frame = df if folds is None else folds.model(i, features).transform(df)
        model = estimators[names[at]].fit(frame.filter(F.col(fold_col) != i))
        scored = positive_score(model.transform(frame.filter(F.col(fold_col) == i)))
        return scored.select(row_id, F.col(label).cast("int").alias("label"), F.lit(at * k + i).alias("_mf"), "score")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, [(at, i) for at in range(len(names)) for i in range(k)]))
    aucs = {r["_mf"]: r["roc_auc"] for r in roc_auc(reduce(lambda a, b: a.unionByName(b), parts), model="_mf").collect()}
    return {n: _mean_std(aucs.get(at * k + i) for i in range(k)) for at, n in enumerate(names)}


def cv_score(estimator, df: DataFrame, k: int, fold_col: str = "fold", label: str = "label", parallelism: int = 4):
    """M7: mean and population std of the fold AUCs of one fixed estimator."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=[{}], evaluator=auc_evaluator(label),
                        numFolds=k, foldCol=fold_col, parallelism=parallelism)
    m = cv.fit(df)
    return float(m.avgMetrics[0]), float(m.stdMetrics[0])


def positive_score(df: DataFrame, probability: str = "probability", out: str = "score") -> DataFrame:
    """The positive-class probability as a double column."""
    return df.withColumn(out, vector_to_array(probability)[1])


def predict(model, df: DataFrame, keep: Iterable[str] = (), label: str = "label",
            name: str = "model") -> DataFrame:
    """M9: long score rows ``(*keep, model, label, score, prediction)`` for the metrics module."""
    scored = positive_score(model.transform(df))
    return scored.select(*keep, F.lit(name).alias("model"), F.col(label).cast("int").alias("label"),
                         "score", F.col("prediction").cast("int").alias("prediction"))
