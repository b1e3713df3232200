"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.sources.io import read_table

#: A word: a run of bytes other than the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Ranges that one hot key is split into before any row-level window (top bits of a 64-bit hash).
RANK_BITS = 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete intermediate data that no plan reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def lean(run: Callable) -> Callable:
    """``run`` for ``mapInArrow`` that gives Arrow memory back after each batch: Python workers live on
    from stage to stage, and what their pools hold unused would add up."""

    def lean_run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one_by_one() -> Iterator[pa.RecordBatch]:
            for block in blocks:
                yield block
                del block
                pa.default_memory_pool().release_unused()

        yield from run(one_by_one())
        pa.default_memory_pool().release_unused()

    return lean_run


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def distributed_rank(df: DataFrame, keys: list[str], hash_col: str, ties: list[str],
                     name: str, extra: DataFrame | None = None) -> DataFrame:
    """Add ``name``: each row's 0-based position within its ``keys``, ordered by the hash, then
    ``ties``. ``keys`` must not be null; ``extra`` (one row per ``keys``) is joined on the way.

    Two levels, so that no key meets in one task: rows are counted per (keys, hash range), running
    sums of these counts give each range its offset, and rows are numbered inside one range only.
    A key that holds every row is spread over ``2**RANK_BITS`` ranges. Rows that agree in hash and
    ties are numbered in any order.
    """
    cell = free_name(df, "_range")
    ranged = df.withColumn(cell, F.shiftrightunsigned(F.col(hash_col), 64 - RANK_BITS).cast("int"))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys, cell).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .drop("_n"))
    if extra is not None:
        offsets = offsets.join(extra, keys)
    inside = Window.partitionBy(*keys, cell).orderBy(hash_col, *ties)
    return (ranged.join(offsets, [*keys, cell])
            .withColumn(name, F.row_number().over(inside) - 1 + F.col("_offset"))
            .drop(cell, "_offset"))
