"""Sources and sinks: raw CSV in, parquet out, run records appended, models stored.

Paths are any Hadoop file-system URI (local, HDFS, object stores), so the same call reads one
file or a folder of thousands of part files; Spark splits them into tasks.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("tabflow")

# Text read as missing (the markers a pandas CSV reader treats as NA by default).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _header(spark: SparkSession, path: str) -> list[str]:
    # Reading only the header line: a one-row job on the first file, not a scan of the data.
    first = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)
    return first.columns


def _by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files under ``path`` by their header line, which a file's first block starts with."""
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                          F.col("_metadata.file_block_start").alias("at"))
             .filter("at = 0").withColumn("n", F.monotonically_increasing_id()))
    groups: dict[str, list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "n").alias("header")).collect():
        groups.setdefault(row["header"], []).append(row["file"])
    return groups


def na_to_null(df: DataFrame) -> DataFrame:
    """NA markers → NULL in every (text) column."""
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    return df.select(*[
        F.when(F.array_contains(tokens, F.trim(F.col(c))), F.lit(None).cast("string"))
         .otherwise(F.col(c)).alias(c) for c in df.columns])


def read_raw(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
             missing_ok: bool = False, multi_line: bool = False, mixed_headers: bool = False) -> DataFrame | None:
    """Read CSV with a header, every column as text, NA markers → NULL.

    Quotes inside quoted text are doubled (``"a ""b"", c"``); ``multi_line`` allows line breaks
    inside quotes (a file is then one task). Every file's header must name the columns in the same
    order, which is checked: values never land in another column. With ``mixed_headers`` files are
    read by header and united by name instead (one more pass reads the header lines).

    Types are assigned by the clean step, so a stray word in a numeric column never fails the
    read or widens the column. With ``missing_ok`` a path that does not exist returns None (and is
    logged); any other error propagates.
    """
    try:
        if mixed_headers:
            groups = _by_header(spark, path)
            if len(groups) > 1:
                parts = [read_raw(spark, files, multi_line=multi_line) for _, files in sorted(groups.items())]
                return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        names = columns or _header(spark, path)
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
        df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
              .option("multiLine", multi_line).option("enforceSchema", False).schema(schema).csv(path))
        if columns is None:
            df.schema  # resolve now so a missing path raises here
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            log.error("input not found: %s", path)
            return None
        raise
    return na_to_null(df)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a table as is: Spark splits the files into tasks, and column pruning and filters
    reach the scan. (Spreading a single-split input over the cores with a round-robin shuffle was
    measured: it slowed the cheap queries more than it sped up the hash-heavy ones.)"""
    return spark.read.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                single_file: bool = False, mode: str = "overwrite") -> None:
    """Write the combined table. Partitioned by lineage by default, so a later filter on one
    source reads only its folder; ``single_file`` coalesces to one task on request only."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by is None and "source" in df.columns and not single_file:
        partition_by = ["source"]
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("mode", T.StringType()),
    T.StructField("total_runtime_seconds", T.DoubleType()),
    T.StructField("stage_seconds", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
])


def append_run(df_row: DataFrame, path: str) -> None:
    """Append run records to a table with a fixed schema (columns never drift)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df_row.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA.fields]
    df_row.select(*cols).write.mode("append").parquet(path)


def fingerprint(df: DataFrame, extra: str = "") -> str:
    """A key for materialised data: the analysed plan plus the input files it reads.

    Keying by a file name alone reuses stale data after the input changes; the plan hash and the
    files' names, lengths and modification times change with both the query and the input.
    """
    h = hashlib.sha256()
    h.update(str(df.semanticHash()).encode())
    files = df.inputFiles()
    if files:  # metadata only: no file's content is read
        listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        for row in sorted(map(str, listed.collect())):
            h.update(row.encode())
    h.update(extra.encode())
    return h.hexdigest()[:20]


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been committed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def checkpointed(df: DataFrame, base_path: str, key: str | None = None) -> DataFrame:
    """Materialise ``df`` once as parquet under ``base_path/key`` and read it back.

    The written table lives in the shared checkpoint folder, so it also cuts lineage and survives
    lost executors; a second call with the same fingerprint reuses it.
    """
    return cached(df.sparkSession, base_path, key or fingerprint(df), lambda: df)


def cached(spark: SparkSession, base_path: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """S7 for frames whose making itself runs jobs: ``make`` is called only when no committed table
    stands under ``base_path/key``."""
    path = f"{base_path.rstrip('/')}/{key}"
    if not _complete(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_path(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate data, under this application's own in the shared checkpoint
    folder."""
    import uuid

    from tabflow.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/tabflow-tmp/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def drop_intermediate(spark: SparkSession) -> None:
    """Delete this application's intermediate data. Frames that were returned but not yet written or
    collected read from it, so call it when results have been consumed."""
    from tabflow.session import checkpoint_dir
    p = spark._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_dir(spark)}/tabflow-tmp/{spark.sparkContext.applicationId}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once under the shared checkpoint folder (a run-scoped path)
    and read it back: later passes read it instead of recomputing its lineage, and a lost
    executor costs a re-read, not a recomputation from the sources."""
    path = run_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_model(model: PipelineModel, df: DataFrame, path: str, n_example: int = 5) -> None:
    """Store a fitted pipeline with a small input example and its schema."""
    model.write().overwrite().save(f"{path}/model")
    df.limit(n_example).write.mode("overwrite").parquet(f"{path}/input_example")
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(df.schema.jsonValue()),)], "schema string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/schema")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
