"""Profiling: describe, null counts, value and category counts, histograms, head.

Per-column statistics are computed for all columns in one aggregate (never one job per
column) and returned in long form, one row per column. Exact quantiles avoid the built-in
``percentile`` aggregate, whose final buffer holds every distinct value of a column in one task:
they narrow value intervals around the wanted ranks by binned counts (``exact_quantiles``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions.exprs import to_double
from tabflow.functions.ranks import approx_splits, buckets_for, prefix_before, with_bucket

DESCRIBE_PROBS = (0.25, 0.5, 0.75)
# Groups that the tasks' sketches are merged in before the last merge.
SKETCH_SALTS = 64
DEFAULT_BINS = 4096
# A value interval with at most this many values is ranked by one window (one task sorts it);
# larger ones are split again.
WINDOW_MAX_ROWS = 65_536
EQUAL_WIDTH_LEVELS = 3
DESCRIBE_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("p25", T.DoubleType()),
    T.StructField("p50", T.DoubleType()),
    T.StructField("p75", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
])


def numeric_view(df: DataFrame, cols) -> DataFrame:
    """The listed columns as finite doubles (text parsed; NaN and infinity → NULL)."""
    return df.select(*[to_double(df.schema, c).alias(c) for c in cols])


def to_long(df: DataFrame, cols, name_col: str = "column_name", value_col: str = "value") -> DataFrame:
    """Wide → long ``(column, value)``: one Expand, so one shuffle serves all columns later."""
    return df.unpivot([], list(cols), name_col, value_col)


@dataclass
class _Region:
    """A value interval ``[lo, hi]`` of one column holding ``n`` values, the first of which has
    rank ``start`` in the column; ``ranks`` are the wanted column ranks inside it."""
    column: str
    lo: float
    hi: float
    start: int
    n: int
    ranks: set = field(default_factory=set)

    def rows(self) -> Column:
        return (F.col("column_name") == F.lit(self.column)) & \
            F.col("value").between(F.lit(self.lo), F.lit(self.hi))


def _moments(num: DataFrame, cols):
    """count, mean, sample std, min, max of every column in one aggregate (one row)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    return num.agg(*aggs).collect()[0]


def _region_id(regions) -> Column:
    """Index of the region a long row falls in, NULL outside all (regions never overlap)."""
    e = None
    for i, r in enumerate(regions):
        e = F.when(r.rows(), F.lit(i)) if e is None else e.when(r.rows(), F.lit(i))
    return e


def _width_bin(r: _Region, bins: int) -> Column:
    """Equal-width bin of ``value`` over ``[r.lo, r.hi]``: monotone in the value, so every bin is
    exactly the interval between its smallest and largest value. Halving first keeps the span
    finite for any pair of finite doubles; min lands in bin 0 and max in the last bin, so a split
    always separates them."""
    k = bins / (r.hi * 0.5 - r.lo * 0.5)
    if not math.isfinite(k):
        # a span of a few ulps: split off the lowest value
        return (F.col("value") > F.lit(r.lo)).cast("int")
    x = (F.col("value") * F.lit(0.5) - F.lit(r.lo * 0.5)) * F.lit(k)
    return F.least(F.floor(x).cast("int"), F.lit(bins - 1))


def _split(long: DataFrame, regions, level: int, bins: int, accuracy: int | None) -> list:
    """Split every region into bins in one aggregate (``regions × bins`` rows reach the driver)
    and keep the bins holding a wanted rank. Early levels use equal-width bins; data that is
    still concentrated after ``EQUAL_WIDTH_LEVELS`` splits (values spread over many orders of
    magnitude) gets rank-balanced split points from a sketch instead."""
    part = long.withColumn("_r", _region_id(regions)).filter(F.col("_r").isNotNull())
    if level < EQUAL_WIDTH_LEVELS:
        b = None
        for i, r in enumerate(regions):
            t = _width_bin(r, bins)
            b = F.when(F.col("_r") == i, t) if b is None else b.when(F.col("_r") == i, t)
        part = part.withColumn("_bucket", b)
    else:
        part = with_bucket(part, "_r", "value", approx_splits(part, "_r", "value", bins, accuracy))
        # split points may all equal a hot value; the minimum in a bin of its own below every
        # other bin keeps the binning monotone and makes every split shrink the interval
        low = None
        for i, r in enumerate(regions):
            t = (F.col("_r") == i) & (F.col("value") == F.lit(r.lo))
            low = F.when(t, F.lit(-1)) if low is None else low.when(t, F.lit(-1))
        part = part.withColumn("_bucket", low.otherwise(F.col("_bucket")))
    counts: dict[int, list] = {}
    for row in (part.groupBy("_r", "_bucket")
                .agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("lo"),
                     F.max("value").alias("hi")).collect()):
        counts.setdefault(row["_r"], []).append((row["_bucket"], row["cnt"], row["lo"], row["hi"]))
    out = []
    for i, r in enumerate(regions):
        start = r.start
        children: dict[int, _Region] = {}
        for b, cnt, lo, hi in sorted(counts.get(i, [])):
            for rank in r.ranks:
                if start <= rank < start + cnt:
                    children.setdefault(b, _Region(r.column, lo, hi, start, cnt)).ranks.add(rank)
            start += cnt
        out += children.values()
    return out


def _values_at_ranks(long: DataFrame, regions) -> dict:
    """Exact values at the wanted ranks of small regions: distinct values with their counts, one
    window per region (at most ``WINDOW_MAX_ROWS`` values each), only rank-holding rows collected."""
    if not regions:
        return {}
    d = (long.withColumn("_r", _region_id(regions)).filter(F.col("_r").isNotNull())
         .groupBy("_r", "value").agg(F.count(F.lit(1)).alias("cnt")))
    ranked = prefix_before(d, ["_r"], "value", "cnt", "start").withColumn("end", F.col("start") + F.col("cnt"))
    # plain comparisons (a few ranks per region) stay in whole-stage codegen
    pick = None
    for i, r in enumerate(regions):
        hit = None
        for rank in sorted(r.ranks):
            t = (F.col("start") <= F.lit(rank - r.start)) & (F.col("end") > F.lit(rank - r.start))
            hit = t if hit is None else hit | t
        t = (F.col("_r") == F.lit(i)) & hit
        pick = t if pick is None else pick | t
    out = {}
    for row in ranked.filter(pick).select("_r", "value", "start", "end").collect():
        r = regions[row["_r"]]
        for rank in r.ranks:
            if row["start"] <= rank - r.start < row["end"]:
                out[(r.column, rank)] = row["value"]
    return out


def exact_quantiles(df: DataFrame, cols, probs=DESCRIBE_PROBS, n_buckets: int | None = None,
                    accuracy: int | None = None, stats=None) -> tuple[dict, object]:
    """Exact linear-interpolated quantiles (``quantile_cont``) of each column.

    Range refinement, no global sort and no sketch on the common path: the moments pass gives
    each column's [min, max]; each pass splits the value intervals that hold a wanted rank into
    ``n_buckets`` bins (all columns in one aggregate) and keeps only the bins holding a wanted
    rank; an interval of one value is resolved on the driver, one of at most ``WINDOW_MAX_ROWS``
    values goes to a final window over its distinct values. Every pass reads the whole column
    but shuffles only ``intervals × bins`` partial counts. Returns ({column: [q...]}, moments row).
    """
    cols = list(cols)
    num = numeric_view(df, cols)
    row = stats if stats is not None else _moments(num, cols)
    max_n = max([row[f"n{i}"] or 0 for i in range(len(cols))] or [0])
    bins = n_buckets or buckets_for(max_n, DEFAULT_BINS)
    long = to_long(num, cols).filter(F.col("value").isNotNull())
    regions = []
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if n:
            wanted = {r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
            regions.append(_Region(c, row[f"lo{i}"], row[f"hi{i}"], 0, n, wanted))
    found: dict = {}
    ready = []
    level = 0
    while regions:
        for r in regions:
            if r.lo == r.hi:
                found.update({(r.column, rank): r.lo for rank in r.ranks})
        ready += [r for r in regions if r.lo != r.hi and r.n <= WINDOW_MAX_ROWS]
        big = [r for r in regions if r.lo != r.hi and r.n > WINDOW_MAX_ROWS]
        regions = _split(long, big, level, bins, accuracy) if big else []
        level += 1
    found.update(_values_at_ranks(long, ready))
    result = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if not n:
            result[c] = [None] * len(probs)
            continue
        qs = []
        for p in probs:
            pos = p * (n - 1)
            lo_r, hi_r = math.floor(pos), math.ceil(pos)
            lo_v, hi_v = found[(c, lo_r)], found[(c, hi_r)]
            qs.append(lo_v if lo_r == hi_r else lo_v + (hi_v - lo_v) * (pos - lo_r))
        result[c] = qs
    return result, row


def describe_exact(df: DataFrame, cols, n_buckets: int | None = None) -> DataFrame:
    """A1: count, mean, sample std, min, exact 25/50/75 %, max per column, one row per column."""
    cols = list(cols)
    row = _moments(numeric_view(df, cols), cols)
    qs, _ = exact_quantiles(df, cols, DESCRIBE_PROBS, n_buckets, stats=row)
    rows = [(c, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], *qs[c], row[f"hi{i}"])
            for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def describe_approx(df: DataFrame, cols, accuracy: int = 10000) -> DataFrame:
    """A2: describe with sketch quantiles, one scan and no collect: the default for big tables.

    Every column has its own mergeable sketch and moments in one wide aggregate, in two levels: tasks
    are dealt to ``SKETCH_SALTS`` groups whose partial results are merged side by side, and only that
    many sketches a column meet in the last merge, however many tasks there are. The rank error stays
    within ``count / accuracy`` with a probability far above 99 % (the sketch's own bound is a third
    of it); sketches hold at most 65,535 values a level."""
    cols = list(cols)
    k = min(65535, max(200, 8 * accuracy))
    salted = numeric_view(df, cols).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SKETCH_SALTS)))
    one, two = [], []
    for i, c in enumerate(cols):
        x = F.col(c)
        one += [F.struct(F.count(x).alias("n"), F.avg(x).alias("m"), (F.var_pop(x) * F.count(x)).alias("d")).alias(f"s{i}"),
                F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.kll_sketch_agg_double(x.cast("double"), F.lit(k)).alias(f"k{i}")]
        two += [_merged_moments(f"s{i}").alias(f"s{i}"), F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"),
                F.kll_merge_agg_double(F.when(F.col(f"s{i}.n") > 0, F.col(f"k{i}"))).alias(f"k{i}")]
    wide = salted.groupBy("_salt").agg(*one).agg(*two)
    rows = []
    for i, c in enumerate(cols):
        n, some = F.col(f"s{i}.n"), F.col(f"s{i}.n") > 0
        q = [F.when(some, F.kll_sketch_get_quantile_double(F.col(f"k{i}"), F.lit(p))) for p in DESCRIBE_PROBS]
        rows.append(F.struct(F.lit(c).alias("column_name"), n.alias("count"), F.when(some, F.col(f"s{i}.m")).alias("mean"),
                             F.when(n > 1, F.sqrt(F.col(f"s{i}.d") / (n - 1))).alias("std"), F.col(f"lo{i}").cast("double").alias("min"),
                             *[v.alias(f"p{int(100 * p)}") for v, p in zip(q, DESCRIBE_PROBS, strict=True)],
                             F.col(f"hi{i}").cast("double").alias("max")))
    return wide.select(F.inline(F.array(*rows)))


def _merged_moments(parts: str):
    """(n, mean, sum of squared deviations) of a few parts' moments, merged pair by pair without
    cancellation."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("d"))

    def merge(a, b):
        n, gap = a["n"] + b["n"], b["m"] - a["m"]
        return F.when(b["n"] == 0, a).otherwise(F.struct(
            n.alias("n"), (a["m"] + gap * b["n"] / n).alias("m"),
            (a["d"] + b["d"] + gap * gap * a["n"] * b["n"] / n).alias("d")))

    return F.aggregate(F.collect_list(parts), zero, merge)


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """A3: NULL count per column (NaN counts as missing), one aggregate, long form."""
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}

    def missing(c):
        x = F.col(c)
        return x.isNull() | F.isnan(x) if c in numeric else x.isNull()
    wide = df.agg(*[F.count_if(missing(c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def total_nulls(df: DataFrame, cols=None) -> DataFrame:
    """A4: total missing cells over the listed columns."""
    return null_counts(df, cols).agg(F.sum("n_null").cast("bigint").alias("n_null_total"))


def columns_with_nulls(df: DataFrame, cols=None) -> DataFrame:
    """only the columns that have missing values."""
    return null_counts(df, cols).filter(F.col("n_null") > 0)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A5: count and share of each non-null value.

    The total is a scalar subquery over the same grouped counts, whose shuffle the plan reuses: the
    input is read once, nothing runs before the query does, and no task holds all values.
    """
    grouped = (df.select(col).filter(F.col(col).isNotNull())
               .groupBy(col).agg(F.count(F.lit(1)).alias("n")))
    return grouped.withColumn("ratio", F.col("n") / grouped.agg(F.sum("n")).scalar())


def category_counts(df: DataFrame, cols) -> DataFrame:
    """Counts of every value of every categorical column: one Expand + one aggregate."""
    cols = list(cols)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return (to_long(text, cols).groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def histogram(df: DataFrame, cols, bins: int = 15) -> DataFrame:
    """Equal-width histogram per column over its own [min, max]; last bin closed on the right.

    One aggregate finds every column's range (two numbers per column reach the driver), then
    one Expand + aggregate counts all bins; a constant column spans [v-0.5, v+0.5].
    """
    cols = list(cols)
    num = numeric_view(df, cols)
    r = num.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).collect()[0]
    ranges = {}
    for i, c in enumerate(cols):
        lo, hi = r[f"lo{i}"], r[f"hi{i}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        ranges[c] = (float(lo), float(hi))
    if not ranges:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, lo double, hi double, n bigint")
    long = to_long(num, list(ranges)).filter(F.col("value").isNotNull())
    lo_e = hi_e = None
    for c, (lo, hi) in ranges.items():
        cond = F.col("column_name") == F.lit(c)
        lo_e = F.when(cond, F.lit(lo)) if lo_e is None else lo_e.when(cond, F.lit(lo))
        hi_e = F.when(cond, F.lit(hi)) if hi_e is None else hi_e.when(cond, F.lit(hi))
    long = long.withColumns({"_lo": lo_e, "_hi": hi_e})
    b = F.least(F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins) + 1,
                F.lit(bins)).cast("int")
    counts = long.withColumn("bin", b).groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
    # every bin is a row, also one without values: columns × bins rows, made here
    grid = df.sparkSession.createDataFrame(
        [(c, i + 1, lo + i * ((hi - lo) / bins), lo + (i + 1) * ((hi - lo) / bins))
         for c, (lo, hi) in ranges.items() for i in range(bins)], "column_name string, bin int, lo double, hi double")
    return (grid.join(counts, ["column_name", "bin"], "left")
            .select("column_name", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n")))


def schema_info(df: DataFrame) -> DataFrame:
    """Column, type and non-missing count, from one aggregate (row count + A3's counts)."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    cols = df.columns

    def present(c):
        x = F.col(c)
        return x.isNotNull() & ~F.isnan(x) if c in numeric else x.isNotNull()
    wide = df.agg(*[F.count_if(present(c)).alias(c) for c in cols])
    counts = wide.unpivot([], cols, "column_name", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column_name string, type string")
    return types.join(counts, "column_name")


def row_count(df: DataFrame) -> DataFrame:
    """A9."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def head_n(df: DataFrame, n: int, order_key) -> DataFrame:
    """A10: the first ``n`` rows by a key (Spark rows have no inherent order): a TakeOrdered."""
    keys = [order_key] if isinstance(order_key, str) else list(order_key)
    return df.orderBy(*keys).limit(n)


def mean_std(df: DataFrame, value: str, by=None) -> DataFrame:
    """Mean and population std of scores (e.g. fold AUCs), optionally per group."""
    keys = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def profile(df: DataFrame, numeric, categorical=(), exact: bool = True) -> dict:
    """All profiles of a cleaned table. Describe and null counts share their scans."""
    out = {"describe": describe_exact(df, numeric) if exact else describe_approx(df, numeric),
           "nulls": null_counts(df, list(numeric) + list(categorical)),
           "histogram": histogram(df, numeric)}
    if categorical:
        out["categories"] = category_counts(df, categorical)
    return out


__all__ = ["describe_exact", "describe_approx", "null_counts", "total_nulls", "columns_with_nulls",
           "value_counts", "category_counts", "histogram", "schema_info", "row_count", "head_n",
           "mean_std", "profile", "exact_quantiles", "to_long", "numeric_view"]
