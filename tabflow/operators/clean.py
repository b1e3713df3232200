"""Clean the harmonised table: drop unlabeled rows, type every role. All projections."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.functions.exprs import category_text, to_double
from tabflow.spec import FeatureSpec

MISSING = "missing"


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """drop rows whose target is NULL."""
    return df.filter(F.col(target).isNotNull())


def dropped_counts(df: DataFrame, target: str, by: str | None = "source") -> DataFrame:
    """rows before and after dropping NULL targets, per source, in one aggregate.

    A grouped count is partially aggregated on the map side, so even a source holding most rows
    sends one row per task to the shuffle.
    """
    keys = [by] if by and by in df.columns else []
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.col(target)).alias("n_kept"))
            .withColumn("n_dropped", F.col("n_rows") - F.col("n_kept")))


def clean_categorical(df: DataFrame, cols) -> DataFrame:
    """Category → text, NULL → 'missing'. Columns of a number type come out canonical ('3', not
    '3.0'); text stays as it is."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(category_text(df.schema, c), F.lit(MISSING)) for c in present}) \
        if present else df


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Number or text → double; bad text, NaN and infinity → NULL."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: to_double(df.schema, c) for c in present}) if present else df


def fill_const(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """NULL → constant."""
    present = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns}
    return df.withColumns(present) if present else df


def binarize_expr(x):
    """P10: truncated to an integer, is it > 0? 0.5 → 0, 4 → 1, 1e30 → 1, bad text → NULL. Compared as
    a double: a number of any size has an answer and none overflows."""
    return (x.cast("double") >= 1.0).cast("int")


def binarize(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, binarize_expr(to_double(df.schema, target)))


def clean(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The whole clean step as one projection over the filtered input.

    Order as in the original workflow: drop rows with no target, categorical to text with
    'missing', binary to number with 0 for missing, numeric to number, target binarised.
    """
    out = drop_null_target(df, spec.target)
    out = clean_categorical(out, spec.categorical)
    out = coerce_numeric(out, spec.binary)
    out = fill_const(out, {c: 0.0 for c in spec.binary})
    out = coerce_numeric(out, spec.numeric)
    return binarize(out, spec.target).filter(F.col(spec.target).isNotNull())
