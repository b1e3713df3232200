"""Run records: one row per run (timings, mode, flattened metrics, params) and a long
``(run_id, model, kind, name, value)`` table; both are appended, never rewritten.

Records are built *from the metric DataFrames* by aggregation (a handful of rows per model),
not from Python dicts, so the schema is fixed and the same code serves any number of models.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.sources.io import append_run

METRIC_COLS = ("accuracy", "precision", "recall", "f1", "roc_auc")


class StageTimer:
    """Wall time per stage as the driver sees it (what a stage leaves lazy counts where it runs)."""

    def __init__(self):
        self.start = time.time()
        self.seconds: dict[str, float] = {}

    @contextmanager
    def stage(self, name: str):
        t0 = time.time()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.time() - t0

    @property
    def total(self) -> float:
        return time.time() - self.start


def metrics_long(evaluated: DataFrame, run_id: str, kind: str = "test",
                 metric_cols=METRIC_COLS) -> DataFrame:
    """``(run_id, model, kind, name, value)`` from a per-model metrics frame."""
    cols = [c for c in metric_cols if c in evaluated.columns]
    long = evaluated.select("model", F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])))
    return long.select(F.lit(run_id).alias("run_id"), "model", F.lit(kind).alias("kind"), "name", "value")


def report_long(report: DataFrame, run_id: str, kind: str = "test") -> DataFrame:
    """R3 for the class report: names ``{metric}_{cls}`` as the flattened record spells them."""
    long = report.select("model", "cls", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1")])))
    return long.select(F.lit(run_id).alias("run_id"), "model", F.lit(kind).alias("kind"),
                       F.concat_ws("_", "metric", "cls").alias("name"), "value")


def by_split(long: DataFrame, suffix: str = "_train") -> DataFrame:
    """Rows of a model scored on its training rows (named with ``suffix``) are filed under the
    model's own name and kind ``train``."""
    own = F.col("model").endswith(suffix)
    return long.select("run_id", F.when(own, F.expr(f"substring(model, 1, length(model) - {len(suffix)})"))
                       .otherwise(F.col("model")).alias("model"),
                       F.when(own, F.lit("train")).otherwise(F.col("kind")).alias("kind"), "name", "value")


def params_long(spark: SparkSession, params: dict, run_id: str) -> DataFrame:
    """The chosen numeric parameters per model, kind ``param``."""
    rows = [(run_id, model, "param", name, float(v)) for model, chosen in params.items()
            for name, v in chosen.items() if isinstance(v, (int, float))]
    return spark.createDataFrame(rows, "run_id string, model string, kind string, name string, value double")


def run_record(spark: SparkSession, long_metrics: DataFrame, run_id: str, mode: str,
               timer: StageTimer, params: dict[str, str]) -> DataFrame:
    """One row: timestamp, runtime, stage seconds, mode, ``{model}_{kind}_{name}`` metrics map,
    params map (best parameters per model as text)."""
    named = long_metrics.select(
        F.concat_ws("_", "model", "kind", "name").alias("k"), F.col("value").alias("v"))
    metrics = named.agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("metrics"))
    stage = F.create_map(*[x for k, v in timer.seconds.items() for x in (F.lit(k), F.lit(float(v)))]) \
        if timer.seconds else F.lit(None).cast("map<string,double>")
    par = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]) \
        if params else F.lit(None).cast("map<string,string>")
    return metrics.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("run_ts"),
                          F.lit(mode).alias("mode"), F.lit(float(timer.total)).alias("total_runtime_seconds"),
                          stage.alias("stage_seconds"), "metrics", par.alias("params"))


def new_run_id() -> str:
    return uuid.uuid4().hex[:16]


def append_records(record: DataFrame, long_metrics: DataFrame, path: str) -> None:
    """S6 + R3: append the run row and its long metrics under ``path``."""
    append_run(record, f"{path.rstrip('/')}/runs")
    long_metrics.write.mode("append").parquet(f"{path.rstrip('/')}/metrics")


__all__ = ["StageTimer", "by_split", "params_long", "metrics_long", "report_long", "run_record", "new_run_id", "append_records"]
