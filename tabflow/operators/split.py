"""Reproducible stratified splits, folds and samples, placed by a hash of the row key.

A row's place depends only on its key and the seed, never on partitioning or arrival order, so
re-running on a re-partitioned or grown table gives the same assignment to the same rows.

Exact per-class ranks without a per-class window (a class may hold a third of all rows, and a
window over it would be one task):

1. ``h`` = 32-bit portable hash of ``(key, seed)``; ``bucket`` = its top ``bucket_bits`` bits, so
   buckets split every class evenly whatever its size;
2. ``dense_rank`` inside ``(class, bucket)`` partitions under the order ``(h, key)``: the one shuffle
   of the rows. Rows with an equal key share a rank, so they never part into different folds;
3. the greatest rank of each bucket, taken on the same partitions, gives a table of at most
   ``classes × 2^bucket_bits`` rows; its running totals are the buckets' offsets;
4. offsets come back by a join on the same two columns, without another shuffle of the rows.

Rows with a NULL in the key have no identity to keep together: they are placed by a hash of the
whole row, so that however many they are they spread over all buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions.exprs import portable_hash

# 2^16 buckets per class: a class of 10^12 rows gives window partitions of ~1.5·10^7 rows, and
# the offsets table stays at most classes × 65,536 rows (AQE measures it before broadcasting).
DEFAULT_BUCKET_BITS = 16


def _keys(key) -> list[str]:
    if not key:
        raise ValueError("a stable row key is required (hash placement needs it)")
    return [key] if isinstance(key, str) else list(key)


def class_ranks(df: DataFrame, label: str, key, seed: int = 42,
                bucket_bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """Adds ``_h`` (hash), ``_rank`` (1-based rank of the row's key inside the class) and
    ``_n_class`` (keys in the class)."""
    keys = _keys(key)
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    row = F.xxhash64(*plain)
    unkeyed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    # the class and the bucket are never null, so the join below is on plain columns
    hashed = (df.withColumn("_h", F.coalesce(portable_hash(keys, seed), F.pmod(row, F.lit(1 << 32))))
              .withColumn("_tie", F.when(unkeyed, row).otherwise(F.lit(0)))
              .withColumn("_class", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
              .withColumn("_bucket", F.coalesce(F.shiftright(F.col("_h"), 32 - bucket_bits), F.lit(-1))))
    inner = Window.partitionBy("_class", "_bucket").orderBy("_h", *keys, "_tie")
    placed = hashed.withColumn("_place", F.dense_rank().over(inner))
    before = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_class", "_bucket").agg(F.max("_place").alias("_cnt"))
               .select("_class", "_bucket", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
                       F.sum("_cnt").over(Window.partitionBy("_class")).alias("_n_class"))
               # back to the rows' partitioning: this small side moves, the rows don't
               .repartition("_class", "_bucket"))
    return (placed.join(offsets, ["_class", "_bucket"])
            .withColumn("_rank", F.col("_place") + F.col("_offset"))
            .drop("_class", "_bucket", "_offset", "_place", "_tie"))


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 42,
                     key=None, bucket_bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """SP1: adds ``split`` ∈ {'train','test'}; per class, ``round(test_frac · n_class)`` keys are
    test (half rounds up), so with one row a key class shares are kept to within half a row."""
    r = class_ranks(df, label, key, seed, bucket_bits)
    n_test = F.floor(F.lit(test_frac) * F.col("_n_class") + F.lit(0.5))
    return (r.withColumn("split", F.when(F.col("_rank") <= n_test, F.lit("test")).otherwise(F.lit("train")))
            .drop("_h", "_rank", "_n_class"))


def train_test(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 42, key=None):
    """SP1 as a pair of DataFrames sharing one ranked plan (persist it when both are used)."""
    s = stratified_split(df, label, test_frac, seed, key)
    return (s.filter(F.col("split") == "train").drop("split"),
            s.filter(F.col("split") == "test").drop("split"))


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42, key=None,
                     fold_col: str = "fold", bucket_bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """SP2/SP3: adds ``fold`` ∈ [0, k): rank in class dealt round-robin, so every fold holds each
    class to within one row. Always hash-shuffled (an unshuffled split would follow file order)."""
    r = class_ranks(df, label, key, seed, bucket_bits)
    return (r.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int"))
            .drop("_h", "_rank", "_n_class"))


def sample_n(df: DataFrame, n: int, seed: int = 42, key=None) -> DataFrame:
    """A repeatable sample of ``min(n, rows)`` rows: the ``n`` smallest hashes of the key.

    A TakeOrdered: each task keeps its own ``n`` best rows, so only ``n × tasks`` rows move.
    Unlike ``df.sample``, the same seed gives the same rows on any partitioning.
    """
    keys = _keys(key)
    return df.withColumn("_h", portable_hash(keys, seed)).orderBy("_h", *keys).limit(n).drop("_h")
