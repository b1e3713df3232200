"""Harmonise differently shaped sources into one declared schema, then union them.

Every step is a projection (one ``select`` each, no shuffle); the union of N sources is one
``Union`` node, so Catalyst pushes filters and column pruning into every source scan, and a
predicate on the lineage literal removes the other branches entirely.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.exprs import canonical_string, category_text, parse_number, to_double
from tabflow.spec import FeatureSpec, SourceSpec

# Above this many keys a recode becomes a lookup join instead of a CASE chain.
RECODE_CASE_LIMIT = 32
# A lookup of at most this many entries is broadcast (its size is the dictionary's, known on the
# driver); a larger one is joined by shuffle.
RECODE_BROADCAST_MAX_KEYS = 1_000_000


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns that are present; absent names are a no-op."""
    present = {old: new for old, new in mapping.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(present) if present else df


def recode_table(mapping: dict[Any, Any]) -> dict[float, str]:
    """The dictionary with its keys as numbers; of keys that are the same number (1 and '1') the
    first counts, whichever way the recode is planned."""
    out: dict[float, str] = {}
    for k, v in mapping.items():
        out.setdefault(float(k), canonical_string(v))
    return out


def recode_expr(c: str, mapping: dict[Any, Any]) -> Column:
    """P2 as an expression: parse the raw value as a number, look it up, emit canonical text.

    Unmapped or unparsable values become NULL. Keys are compared as numbers, so '1', '1.0' and
    1 all hit the key 1; output is the canonical string of the mapped value ('3', not '3.0').
    """
    x = parse_number(c)
    out = None
    for k, v in recode_table(mapping).items():
        cond = x == F.lit(k)
        val = F.lit(v)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out if out is not None else F.lit(None).cast("string")


def recode(df: DataFrame, c: str, mapping: dict[Any, Any]) -> DataFrame:
    """Recode one column by dictionary.

    Small dictionaries become a CASE chain (codegen, no join). A large one becomes a left join
    against the mapping as a DataFrame. Its size is the dictionary's, counted here on the driver,
    so up to ``RECODE_BROADCAST_MAX_KEYS`` entries it is broadcast and the recoded table is never
    shuffled; beyond that the join is left to the planner.
    """
    if c not in df.columns:
        return df
    entries = recode_table(mapping)
    if len(entries) <= RECODE_CASE_LIMIT:
        return df.withColumn(c, recode_expr(c, mapping))
    lookup = df.sparkSession.createDataFrame(list(entries.items()), "_recode_key double, _recode_val string")
    if len(entries) <= RECODE_BROADCAST_MAX_KEYS:
        lookup = F.broadcast(lookup)
    keyed = df.withColumn("_recode_key", parse_number(c))
    cols = [F.col("_recode_val").alias(c) if x == c else F.col(x) for x in df.columns]
    return keyed.join(lookup, "_recode_key", "left").select(*cols)


def tag_source(df: DataFrame, name: str, lineage: str = "source", overwrite: bool = True) -> DataFrame:
    """Tag rows with their source; an existing tag is kept unless ``overwrite``."""
    if lineage in df.columns and not overwrite:
        return df.withColumn(lineage, F.coalesce(F.col(lineage).cast("string"), F.lit(name)))
    return df.withColumn(lineage, F.lit(name))


def add_missing(df: DataFrame, constants: dict[str, Any]) -> DataFrame:
    """Add columns the source lacks, as constants."""
    absent = {c: F.lit(v) for c, v in constants.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def align(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """P5: one ``select`` in spec order; absent columns become NULL, extra ones are dropped.

    Each role gets one type whatever the source had, so all union branches agree: numeric,
    binary and target columns become double (text parsed, NaN/inf → NULL), categorical and
    lineage columns text (of numbers the canonical text, '3' not '3.0'; text as it is). Keys keep
    their type.
    """
    as_double = set(spec.numeric) | set(spec.binary) | {spec.target}
    out = []
    for c in spec.columns:
        if c not in df.columns:
            e = F.lit(None).cast("double" if c in as_double else "string")
        elif c in as_double:
            e = to_double(df.schema, c)
        elif c in spec.key:
            e = F.col(c)
        else:
            e = category_text(df.schema, c)
        out.append(e.alias(c))
    return df.select(*out)


def harmonize(df: DataFrame, source: SourceSpec, spec: FeatureSpec) -> DataFrame:
    """P1-P5 for one source."""
    out = rename(df, source.rename)
    for c, mapping in source.recode.items():
        out = recode(out, c, mapping)
    if spec.lineage:
        out = tag_source(out, source.name, spec.lineage, source.overwrite_tag)
    out = add_missing(out, source.add)
    return align(out, spec)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns absent on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def combine(sources: list[tuple[DataFrame, SourceSpec]], spec: FeatureSpec) -> DataFrame:
    """Harmonise each source once, then one N-way union."""
    if not sources:
        raise ValueError("combine needs at least one source")
    missing = [s.name for df, s in sources if df is None]
    if missing:
        raise ValueError(f"source(s) not loaded: {missing}")
    return union_all([harmonize(df, s, spec) for df, s in sources])
