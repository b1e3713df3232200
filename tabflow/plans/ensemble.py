"""Stacking: out-of-fold scores of the base models feed a meta logistic regression.

Base scores are kept long ``(row_id, label, model, score)`` and pivoted once (one shuffle for k
models, instead of k-1 joins). Out-of-fold fits are a driver loop of ``folds × models``
distributed fits on one cached frame; each row is scored exactly once per model.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.plans.metrics import score_columns
from tabflow.plans.train import PenalizedLogit, positive_score


def oof_scores(estimators: dict, df: DataFrame, k: int, fold_col: str = "fold",
               row_id: str = "row_id", label: str = "label", parallelism: int = 4) -> DataFrame:
    """ST1: for each model and fold i, fit on folds ≠ i and score fold i; one long union.
    ``parallelism`` fits are submitted at once (each is a distributed Spark job)."""
    from concurrent.futures import ThreadPoolExecutor

    def one(task):
        name, i = task
        fitted = estimators[name].fit(df.filter(F.col(fold_col) != i))
        scored = positive_score(fitted.transform(df.filter(F.col(fold_col) == i)))
        return scored.select(row_id, F.col(label).cast("int").alias("label"),
                             F.lit(name).alias("model"), "score")
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, [(n, i) for n in estimators for i in range(k)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def base_scores(models: dict, df: DataFrame, row_id: str = "row_id", label: str = "label") -> DataFrame:
    """ST2: scores of fitted base models on new rows, long form."""
    parts = [positive_score(m.transform(df)).select(
        row_id, F.col(label).cast("int").alias("label"), F.lit(name).alias("model"), "score")
        for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stack_input(scores_long: DataFrame, names, row_id: str = "row_id") -> DataFrame:
    """J2/J3 + assembler: one row per ``row_id`` with a vector of the base scores (width = number
    of base models) and the label carried through the grouping key."""
    wide = score_columns(scores_long, names, row_id=row_id)
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(wide)


def fit_stack(oof_long: DataFrame, names, C: float = 1.0, row_id: str = "row_id"):
    """ST3: the meta model, an L2 logistic regression (C=1) on the out-of-fold score vector."""
    return PenalizedLogit(C=C, labelCol="label", featuresCol="features").fit(
        stack_input(oof_long, names, row_id))


def stacked_scores(meta, base_models: dict, df: DataFrame, row_id: str = "row_id",
                   label: str = "label") -> DataFrame:
    """ST4: base scores on ``df`` → meta model → long stacked score rows for the metrics."""
    names = list(base_models)
    x = stack_input(base_scores(base_models, df, row_id, label), names, row_id)
    scored = positive_score(meta.transform(x))
    return scored.select(row_id, F.lit("stacked").alias("model"), F.col("label").cast("int").alias("label"),
                         "score", F.col("prediction").cast("int").alias("prediction"))


def nested_stack_cv(estimators: dict, df: DataFrame, k: int, C: float = 1.0, fold_col: str = "fold",
                    row_id: str = "row_id", label: str = "label", parallelism: int = 4, folds=None,
                    features: str = "features"):
    """Cross-validated AUC of the whole stack: in each outer fold the base models' out-of-fold scores,
    the meta model and the refitted base models all come from the other folds' rows, so nothing that
    scores a fold has seen it. Returns (mean, population std) over the outer folds.

    The folds of ``df`` are the inner folds too, and fits are shared: a base model fitted without
    folds ``i`` and ``j`` gives fold ``j``'s scores to outer fold ``i`` and the reverse. That is
    ``k (k - 1) / 2`` fits a model, besides the ``k`` that score the outer folds; all are submitted
    as one bounded batch. With ``folds`` every fit's rows are preprocessed by the statistics of the
    folds that it trains on."""
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce

    from tabflow.plans.metrics import roc_auc
    from tabflow.plans.train import _mean_std
    from tabflow.sources.io import materialize
    names = list(estimators)
    left_out = [(i, j) for i in range(k) for j in range(i, k)]  # i = j: the refit that scores outer fold i

    def one(task):
        name, (i, j) = task
        frame = df if folds is None else folds.model((i, j), features).transform(df)
        fitted = estimators[name].fit(frame.filter(~F.col(fold_col).isin(i, j)))
        scored = positive_score(fitted.transform(frame.filter(F.col(fold_col).isin(i, j))))
        # what fold j's rows get belongs to outer fold i and the reverse; the refit's scores are tests
        outer = F.lit(i) if i == j else F.when(F.col(fold_col) == j, F.lit(i)).otherwise(F.lit(j))
        return scored.select(row_id, F.col(label).cast("int").alias("label"), F.lit(name).alias("model"), "score",
                             outer.cast("int").alias("_outer"), F.lit(i == j).alias("_test"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, [(n, pair) for n in names for pair in left_out]))
    long = reduce(lambda a, b: a.unionByName(b), parts)
    wide = (long.groupBy(row_id, "label", "_outer", "_test").pivot("model", names).agg(F.first("score")))
    x = materialize(VectorAssembler(inputCols=names, outputCol="features").transform(wide), "stack-cv")

    def meta(i):
        own = x.filter(F.col("_outer") == i)
        fitted = PenalizedLogit(C=C, labelCol="label", featuresCol="features").fit(own.filter("NOT _test"))
        return positive_score(fitted.transform(own.filter("_test"))).select(row_id, "label", F.lit(i).alias("_fold"), "score")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scored = reduce(lambda a, b: a.unionByName(b), pool.map(meta, range(k)))
    return _mean_std(r["roc_auc"] for r in roc_auc(scored, model="_fold").collect())


def run_stack(estimators: dict, train: DataFrame, test: DataFrame, k: int, fold_col: str = "fold",
              row_id: str = "row_id", label: str = "label", C: float = 1.0, mode: str = "full"):
    """ST1-ST4 end to end. ``mode='full'`` refits each base model on all of train for the test
    scores; ``'last_fold'`` reuses the model of the last out-of-fold fit (the original's
    behaviour, kept only on request). Returns (meta model, base models, stacked test scores)."""
    from concurrent.futures import ThreadPoolExecutor
    names = list(estimators)
    oof = oof_scores(estimators, train, k, fold_col, row_id, label)
    meta = fit_stack(oof, names, C, row_id)
    if mode == "full":
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            base = dict(zip(names, pool.map(lambda n: estimators[n].fit(train), names)))
    elif mode == "last_fold":
        base = {n: e.fit(train.filter(F.col(fold_col) != k - 1)) for n, e in estimators.items()}
    else:
        raise ValueError(f"unknown stacking mode {mode!r}")
    return meta, base, stacked_scores(meta, base, test, row_id, label)


__all__ = ["oof_scores", "base_scores", "stack_input", "fit_stack", "stacked_scores", "run_stack",
           "nested_stack_cv"]
