"""Evaluation over a long score table ``(model, row_id, label, score, prediction)``.

Every model is evaluated in the same aggregates (grouped by ``model``), so comparing k models
costs the scans of one. Everything except AUC is arithmetic on the confusion counts, which one
conditional aggregate produces with no join and no cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.ranks import approx_splits, prefix_before, range_splits, with_bucket
from tabflow.sources.io import materialize

# Flattened report names, as the run record spells them.
REPORT_CLASSES = ("class0", "class1", "macro_avg", "weighted_avg")
REPORT_METRICS = ("precision", "recall", "f1")


def _div(a, b):
    """a / b with 0/0 → 0 (the convention of the original metrics)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion_counts(scores: DataFrame, model: str = "model", label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """E4 (wide): tn, fp, fn, tp per model, one partial-aggregated pass."""
    y, p = F.col(label), F.col(prediction)
    return scores.groupBy(model).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def confusion_matrix(scores: DataFrame, model: str = "model", label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """E4 (long): ``(model, label, prediction, n)``, complete 2×2 grid, zeros included."""
    cc = confusion_counts(scores, model, label, prediction)
    cells = F.array(*[F.struct(F.lit(yv).alias("label"), F.lit(pv).alias("prediction"),
                               F.col(name).alias("n"))
                      for name, yv, pv in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])
    return cc.select(model, F.inline(cells))


def binary_metrics(scores: DataFrame, model: str = "model", label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall, F1 of the positive class (0/0 → 0)."""
    return _metrics_of(confusion_counts(scores, model, label, prediction), model)


def _metrics_of(cc: DataFrame, model: str) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return cc.select(model, _div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                     prec.alias("precision"), rec.alias("recall"),
                     _div(2 * prec * rec, prec + rec).alias("f1"))


def auc_of(num, pos, neg):
    """The statistic over the number of pairs, as doubles: a product of two counts overflows."""
    return num / pos.cast("double") / neg.cast("double")


def roc_auc(scores: DataFrame, model: str = "model", label: str = "label", score: str = "score",
            n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC per model, ties counted half (Mann-Whitney); one class only → NULL.

    ``AUC = Σ_s pos(s)·(neg_below(s) + neg(s)/2) / (P·N)`` over distinct scores. Scores collapse
    to distinct values first (ties and hot values become one row); ``neg_below`` is a two-level
    prefix sum: bucket totals (``models × B`` rows) plus a window inside each bucket, with ``B``
    chosen by refining the range of the scores where they are many (see ``ranks.range_splits``).
    The distinct-score table is written once to the shared checkpoint folder, so ``scores`` (often
    a model's ``transform``) is computed once although the table is read twice.
    """
    y = F.col(label)
    d = materialize(scores.groupBy(model, score).agg(F.count_if(y == 1).alias("_pos"),
                                                     F.count_if(y == 0).alias("_neg")), "auc-scores")
    return _auc_from(d, model, score, n_buckets)


def _auc_from(d: DataFrame, model: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """E3 from a stored table of distinct scores with their ``_pos`` and ``_neg`` rows."""
    splits = range_splits(d, model, score) if n_buckets is None else approx_splits(d, model, score, n_buckets)
    db = with_bucket(d, model, score, splits)
    if all(len(sp) < 3 for sp in splits.values()):
        # every model fits in one bucket: no offsets to add
        db = db.withColumn("_off", F.lit(0))
    else:
        tot = db.groupBy(model, "_bucket").agg(F.sum("_neg").alias("_bneg"))
        before = Window.partitionBy(model).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        tot = tot.select(model, "_bucket", F.coalesce(F.sum("_bneg").over(before), F.lit(0)).alias("_off"))
        db = db.join(tot, [model, "_bucket"])
    db = prefix_before(db, [model, "_bucket"], score, "_neg", "_nb")
    agg = db.groupBy(model).agg(
        F.sum(F.col("_pos").cast("double") * (F.col("_off") + F.col("_nb") + F.col("_neg") / 2.0)).alias("_num"),
        F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    return agg.select(model, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                                    auc_of(F.col("_num"), F.col("_P"), F.col("_N"))).alias("roc_auc"))


def class_report(scores: DataFrame, model: str = "model", label: str = "label",
                 prediction: str = "prediction") -> DataFrame:
    """E5: per-class precision/recall/F1/support plus macro and weighted averages, long form
    ``(model, cls, precision, recall, f1, support)``; the only data pass is the confusion count."""
    cc = confusion_counts(scores, model, label, prediction)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1, f1_0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("cls"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("bigint").alias("support"))
    rows = F.array(
        row("class0", p0, r0, f1_0, s0), row("class1", p1, r1, f1_1, s1),
        row("macro_avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted_avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n),
            _div(f1_0 * s0 + f1_1 * s1, n), n))
    return cc.select(model, F.inline(rows))


def flatten_report(report: DataFrame, model: str = "model", models=None) -> DataFrame:
    """The report as one row, columns ``{model}_{metric}_{cls}`` (explicit pivot values, so no
    extra job discovers them)."""
    long = report.select(model, "cls", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in REPORT_METRICS])))
    names = F.concat_ws("_", F.col(model), F.col("metric"), F.col("cls"))
    long = long.withColumn("_name", names)
    values = None
    if models is not None:
        values = [f"{mo}_{me}_{c}" for mo in models for me in REPORT_METRICS for c in REPORT_CLASSES]
    return long.groupBy().pivot("_name", values).agg(F.first("value"))


def evaluate(scores: DataFrame, model: str = "model", label: str = "label", score: str = "score",
             prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1, ROC AUC for every model, one row per model.

    ``scores`` (often several models' ``transform``) is computed once: counts by model, score and
    prediction are written, and both the confusion counts and the AUC come from them."""
    y, p = F.col(label), F.col(prediction)
    d = materialize(scores.groupBy(model, score, prediction).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg")), "score-counts")

    def rows(said: int, count: str):
        return F.sum(F.when(p == said, F.col(count)).otherwise(F.lit(0)))

    cc = d.groupBy(model).agg(rows(0, "_neg").alias("tn"), rows(1, "_neg").alias("fp"),
                              rows(0, "_pos").alias("fn"), rows(1, "_pos").alias("tp"))
    distinct = d.groupBy(model, score).agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    return _metrics_of(cc, model).join(_auc_from(distinct, model, score), model, "left")


def top_k(df: DataFrame, value: str, k: int, tie: str, by_abs: bool = False) -> DataFrame:
    """The k largest rows by value (or |value|), ties by name: a TakeOrdered."""
    key = F.abs(F.col(value)) if by_abs else F.col(value)
    return df.orderBy(key.desc(), F.col(tie)).limit(k)


def score_columns(scores: DataFrame, models, row_id: str = "row_id", model: str = "model",
                  score: str = "score", label: str = "label") -> DataFrame:
    """Long ``(row_id, model, score, label)`` → one row per ``row_id`` with a column per
    model and the label carried along, in one partial-aggregated shuffle instead of k-1 joins.

    ``row_id`` is a row's identity, made before scoring (``workflow.row_identity``): a row only ever
    gets its own scores. An id that comes twice in a model, or with two labels, names more than one
    row, and is an error instead of a guess which scores belong together."""
    def refuse(why: str):
        return F.raise_error(F.concat(F.lit(f"{why} for id "), F.col(row_id).cast("string")))

    of = [F.col(model) == F.lit(m) for m in models]
    one_label = F.min(label).eqNullSafe(F.max(label)) & (F.count(label).isin(0, F.count(F.lit(1))))
    return scores.groupBy(row_id).agg(
        F.when(~F.coalesce(one_label, F.lit(False)), refuse("more than one label").cast(scores.schema[label].dataType))
        .otherwise(F.max(label)).alias(label),
        *[F.when(F.count_if(is_m) > 1, refuse(f"more than one score of {m}").cast("double"))
          .otherwise(F.max(F.when(is_m, F.col(score)))).alias(m) for m, is_m in zip(models, of, strict=True)])
