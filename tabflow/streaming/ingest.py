"""Incremental ingest: the batch operators applied to source files as they arrive.

Harmonise and clean are stateless projections and filters, so Structured Streaming runs them
unchanged on a file stream; nothing here is a new operator. Each source folder becomes one
stream; the streams are unioned and appended to the combined table (partitioned by source),
exactly once, with progress kept in the shared checkpoint folder so a restarted or re-scheduled
query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabflow.operators import clean as C
from tabflow.operators import harmonize as H
from tabflow.session import checkpoint_dir
from tabflow.sources.io import na_to_null
from tabflow.spec import FeatureSpec, SourceSpec


def read_raw_stream(spark: SparkSession, folder: str, columns: list[str],
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: CSV files with a header, every column as text, NA markers → NULL."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    reader = spark.readStream.option("header", True).option("escape", '"').option("enforceSchema", False).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return na_to_null(reader.csv(folder))


def combined_stream(sources: list[tuple[DataFrame, SourceSpec]], spec: FeatureSpec) -> DataFrame:
    """U2 + clean on streams: the same plan as the batch ``combine`` + ``clean``."""
    return C.clean(H.combine(sources, spec), spec)


def start_ingest(df: DataFrame, out_path: str, name: str = "tabflow_ingest",
                 available_now: bool = True, checkpoint: str | None = None) -> StreamingQuery:
    """S5 as a stream: append to parquet partitioned by source. ``available_now`` processes what
    has arrived and stops (a scheduled incremental batch); otherwise it runs continuously."""
    spark = df.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{name}"
    w = (df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ckpt)
         .outputMode("append").queryName(name))
    if "source" in df.columns:
        w = w.partitionBy("source")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def score_stream(model, df: DataFrame, keep: list[str], name: str = "model") -> DataFrame:
    """A fitted pipeline (features + classifier) applied to a stream: every stage is a row-wise
    transform, so new records are scored as they arrive."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    return out.select(*keep, F.lit(name).alias("model"),
                      vector_to_array("probability")[1].alias("score"),
                      F.col("prediction").cast("int").alias("prediction"))
