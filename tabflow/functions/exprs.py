"""Column expressions shared by the operators. All are built-in Spark SQL functions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number when text is coerced. Plain decimal or scientific
# notation only; words such as NaN, inf, True and type suffixes such as 1d are not numbers.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c: str | Column) -> Column:
    """Text or number → double; anything that is not a finite number becomes NULL.

    ANSI mode makes ``cast`` raise on bad text, so ``try_cast`` behind a regex guard is used:
    Spark alone would accept ``'1d'``, ``'NaN'`` and ``'inf'``.
    """
    s = F.trim(col_of(c).cast("string"))
    d = s.try_cast("double")
    # a number beyond a double's range, such as 1e999, is read as infinity
    return F.when(s.rlike(NUMBER_PATTERN) & (F.abs(d) != F.lit(float("inf"))), d)


def finite_or_null(x: Column) -> Column:
    """A numeric column as double, with NaN and ±infinity → NULL (no text round trip)."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def to_double(df_schema, c: str) -> Column:
    """``parse_number`` that skips the text round trip when the column is already numeric.

    Integral and decimal columns cannot hold NaN or infinity, so they only get a cast, which the
    optimizer unwraps again in comparisons: a filter on the harmonised column still reaches the
    parquet scan as a pushed filter. Only float/double columns need the NaN/infinity guard."""
    from pyspark.sql.types import BooleanType, DecimalType, IntegralType, NumericType
    dtype = df_schema[c].dataType
    if isinstance(dtype, (IntegralType, DecimalType)):
        return F.col(c).cast("double")
    if isinstance(dtype, NumericType):
        return finite_or_null(F.col(c))
    if isinstance(dtype, BooleanType):
        return F.lit(None).cast("double")  # words are not numbers, as for text 'True'
    return parse_number(c)


def category_text(df_schema, c: str) -> Column:
    """A category as text. Only a column whose type is a number is rewritten (3.0 → '3', NaN →
    NULL); text is kept as it is, since '007', '1e3' and long digit strings are codes."""
    from pyspark.sql.types import DecimalType, FractionalType
    x = F.col(c)
    if not isinstance(df_schema[c].dataType, FractionalType):
        return x.cast("string")
    if isinstance(df_schema[c].dataType, DecimalType):
        return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))
    d = x.cast("double")
    whole = (d == F.floor(d)) & (F.abs(d) < F.lit(2.0 ** 63))
    return F.when(~F.isnan(d), F.when(whole, F.when(whole, d).cast("bigint").cast("string"))
                  .otherwise(x.cast("string")))


def nan_to_null(c: str | Column) -> Column:
    """NaN → NULL (Spark keeps two missing-value concepts; aggregates treat NaN as a value)."""
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def canonical_string(value) -> str:
    """The text form of a mapped value: integral numbers without a trailing '.0'."""
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def portable_hash(key_cols: Iterable[str | Column], seed: int) -> Column:
    """A 32-bit non-negative hash of ``key:...:seed`` that DuckDB can reproduce.

    ``conv(substr(md5(s), 1, 8), 16, 10)`` here equals ``('0x' || substr(md5(s), 1, 8))::BIGINT``
    there, so split and fold assignments can be checked by an independent engine. Rows are
    placed by their key alone, so the result does not depend on partitioning.
    """
    parts: list[Column] = []
    for c in key_cols:
        parts.append(col_of(c).cast("string"))
        parts.append(F.lit(":"))
    parts.append(F.lit(str(seed)))
    return F.conv(F.substr(F.md5(F.concat(*parts)), F.lit(1), F.lit(8)), 16, 10).cast("bigint")


def round6(c: str | Column) -> Column:
    return F.round(col_of(c), 6)
