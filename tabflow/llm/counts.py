"""Token counts through a digest cache.

A text is normalised only where that cannot change its count (null becomes empty) and known by the
SHA-256 of its bytes; the tokenizer by a digest of its file and library version. Counts kept in the
cache table under both digests are joined; of the texts that it lacks each distinct one is encoded
once, and its count is appended. Copies of one text, however many, are reduced to one row before
the shuffle; afterwards only digests and counts move.

Defined results: a null or empty text has 0 tokens; an empty table gives an empty result; repeated
rows each get their count; texts of any length are encoded whole. Two runs that append the same
digest at a time leave equal rows, of which reading takes one. A run that fails before its append
leaves the cache as it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.llm.pretokens import column_batches
from tabflow.llm.tokenizers import text_coder, version_digest

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit). ``cache_path``: a folder in the shared store, kept
    from run to run; ``tokenizer_path``: a file that every executor has."""
    spark = docs.sparkSession
    version = version_digest(tokenizer_path)
    rows = (docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
            .withColumn("digest", F.unhex(F.sha2("_text", 256))))
    misses = rows.select("digest", "_text").dropDuplicates(["digest"])
    cached = _read(spark, cache_path, version)
    if cached is not None:
        misses = misses.join(cached, "digest", "left_anti")

    def encode(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_coder(tokenizer_path)
        for block in blocks:
            for lo, hi in column_batches(block.column(1)):
                _, counts = coder(block.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [block.column(0).slice(lo, hi - lo), pa.array(np.asarray(counts), pa.int64())],
                    names=["digest", "n_tokens"])

    (misses.mapInArrow(encode, "digest binary, n_tokens bigint")
     .withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_path))
    counts = _read(spark, cache_path, version)
    return (rows.select("_id", F.octet_length("_text").cast("bigint").alias("n_bytes"), "digest")
            .join(counts, "digest")
            .select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def _read(spark, cache_path: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) of one tokenizer; None where there is no cache yet."""
    try:
        found = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException:
        return None
    return (found.filter(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.first("n_tokens").alias("n_tokens")))
