"""Order statistics without a single-task sort.

Exact quantiles and exact prefix sums (AUC) both need "how many values lie below this one".
A plain window over a whole column runs in one task. Instead:

1. a mergeable sketch (``percentile_approx``) gives each group ``B-1`` split points: a bounded,
   parameter-sized array per group, collected to the driver;
2. ``Bucketizer`` (a JVM binary search) maps every value to its range bucket;
3. counts per ``(group, bucket)`` form a table of at most ``groups × B`` rows, the only thing
   ordered across buckets;
4. exact work (windows, ranks) happens inside ``(group, bucket)`` partitions, each about
   ``rows / B`` rows and collapsed to distinct values first, so a hot value is one row.

Groups are a caller-declared list (columns being profiled, models being evaluated), so every
broadcast or collected table here has a size fixed by ``len(groups) × B``.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")
DEFAULT_BUCKETS = 1024
# Above this many rows per bucket the sketch is redone with more buckets, so that the exact
# per-bucket work (a sort inside one task) stays small whatever the table size.
MAX_ROWS_PER_BUCKET = 2_000_000
# Rows of one key that are numbered in a single window, and ranges that a key with more is split into.
HOT_ROWS = 1_000_000
RANGE_BITS = 9
# Bins that a range with too many rows is counted in.
RANGE_WIDTH = 4096


def buckets_for(n_rows: int, n_buckets: int = DEFAULT_BUCKETS) -> int:
    """The bucket count that keeps ``n_rows / buckets`` under ``MAX_ROWS_PER_BUCKET``."""
    b = n_buckets
    while n_rows / b > MAX_ROWS_PER_BUCKET:
        b *= 2
    return b


def bucket_probs(n_buckets: int) -> list[float]:
    return [i / n_buckets for i in range(1, n_buckets)]


def splits_from_bounds(bounds) -> list[float]:
    """Strictly increasing Bucketizer splits from sketch boundaries (repeats of a hot value
    collapse to one split)."""
    inner = sorted({float(b) for b in (bounds or []) if b is not None})
    return [-INF] + inner + [INF]


def approx_splits(long_df: DataFrame, group_col: str, value_col: str,
                  n_buckets: int | None = None, accuracy: int | None = None) -> dict:
    """Per group, range split points. Returns {group: splits}.

    The bucket count follows the data: a count per group comes first, and only groups too big
    for one bucket (more than ``MAX_ROWS_PER_BUCKET`` rows) pay for a sketch pass, with enough
    buckets to bring every bucket under that bound. ``n_buckets`` forces a bucket count.
    """
    if n_buckets is None:
        counts = long_df.groupBy(group_col).agg(F.count(value_col).alias("n")).collect()
        n_buckets = buckets_for(max([r["n"] for r in counts] or [0]), 1)
        if n_buckets == 1:
            return {r[0]: [-INF, INF] for r in counts}
    acc = accuracy or max(10000, 10 * n_buckets)
    rows = (long_df.groupBy(group_col)
            .agg(F.percentile_approx(value_col, bucket_probs(n_buckets), acc).alias("b"))
            .collect())
    return {r[0]: splits_from_bounds(r["b"]) for r in rows}


def range_splits(long_df: DataFrame, group_col: str, value_col: str, width: int = RANGE_WIDTH) -> dict:
    """Per group, split points that leave at most ``MAX_ROWS_PER_BUCKET`` rows in a bucket, as long as
    values differ. Returns {group: splits}.

    By refinement instead of a sketch: rows are counted in ``width`` equal bins of every bucket that
    holds too many, neighbouring bins are put together as long as they fit, and only bins that are
    still too full are looked at again. A pass brings buckets × ``width`` counts to the driver, so
    values crowded in a narrow range cost passes, not memory.
    """
    most = MAX_ROWS_PER_BUCKET
    rows = long_df.filter(F.col(value_col).isNotNull()).select(group_col, F.col(value_col).cast("double").alias("_v"))
    first = rows.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()
    splits = {r[0]: [-INF, INF] for r in first}
    open_ = {(r[0], r["lo"], r["hi"]) for r in first if r["n"] > most and r["lo"] < r["hi"]}
    while open_:
        table = long_df.sparkSession.createDataFrame(
            [(g, lo, hi) for g, lo, hi in open_], rows.select(F.col(group_col).alias("_g"), F.col("_v").alias("lo"), F.col("_v").alias("hi")).schema)
        inside = rows.join(table, F.col(group_col).eqNullSafe(F.col("_g")) & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        # halves, so that the span of very large values does not overflow
        at = F.floor((F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * width)
        bins = (inside.groupBy("_g", "lo", "hi", F.least(at, F.lit(width - 1)).alias("_bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b")).collect())
        open_, held, before = set(), 0, None
        for r in sorted(bins, key=lambda r: (str(r["_g"]), r["lo"], r["_bin"])):
            if before != (r["_g"], r["lo"]):
                before, held = (r["_g"], r["lo"]), 0
                splits[r["_g"]].append(r["a"])
            elif held + r["n"] > most:
                held = 0
                splits[r["_g"]].append(r["a"])
            held += r["n"]
            if r["n"] > most and r["a"] < r["b"]:
                open_.add((r["_g"], r["a"], r["b"]))
    return {g: sorted(set(s)) for g, s in splits.items()}


def with_bucket(long_df: DataFrame, group_col: str, value_col: str, splits: dict,
                out_col: str = "_bucket") -> DataFrame:
    """Add the range bucket of ``value_col`` under its group's splits (NULL value → NULL).

    One input column per group (NULL outside the group) lets a single multi-column Bucketizer
    apply a different split array per group.
    """
    groups = list(splits)
    if not groups or all(len(splits[g]) < 3 for g in groups):
        # one bucket per group: no lookup at all
        return long_df.withColumn(out_col, F.when(F.col(value_col).isNotNull(), F.lit(0)))
    # Bucketizer needs two buckets or more; an extra split point only makes buckets finer
    splits = {g: (sp if len(sp) >= 3 else [-INF, 0.0, INF]) for g, sp in splits.items()}
    ins = [f"_bv{i}" for i in range(len(groups))]
    outs = [f"_bb{i}" for i in range(len(groups))]
    staged = long_df.withColumns({
        ins[i]: F.when(F.col(group_col) == F.lit(g), F.col(value_col).cast("double"))
        for i, g in enumerate(groups)})
    b = Bucketizer(inputCols=ins, outputCols=outs, splitsArray=[splits[g] for g in groups],
                   handleInvalid="keep")
    out = b.transform(staged)
    return out.withColumn(out_col, F.coalesce(*[F.col(o) for o in outs]).cast("int")).drop(*ins, *outs)


def occurrence(df: DataFrame, key: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``out``: each row's 1-based number among the rows with its ``key``, by a hash of the whole
    row. Of rows that agree in everything the numbering is arbitrary, and each has its own.

    Keys of at most ``hot_rows`` rows are numbered in one window each. The few that have more (a table
    of at most ``rows / hot_rows`` keys) are numbered in two levels: equal rows are counted before they
    move, distinct ones are numbered inside a range of the hash, running counts give each range its
    offset, and equal rows are laid out again. So no key meets in one task, however many rows it has.
    """
    from pyspark.sql import Window

    cols = df.columns
    hashed = df.withColumn("_h", F.xxhash64(*cols))
    hot = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
           .select(F.col(key).alias("_hot")))
    one = Window.partitionBy(key).orderBy("_h")
    cool = (hashed.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left_anti")
            .withColumn(out, F.row_number().over(one).cast("bigint")).drop("_h"))

    distinct = (hashed.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left_semi").groupBy(*cols, "_h")
                .agg(F.count(F.lit(1)).alias("_copies"))
                .withColumn("_range", F.shiftrightunsigned("_h", 64 - RANGE_BITS)))
    inside = Window.partitionBy(key, "_range").orderBy("_h", *cols).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (distinct.groupBy(F.col(key).alias("_of"), F.col("_range").alias("_at")).agg(F.sum("_copies").alias("_n"))
               .select("_of", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    laid = (distinct.withColumn("_first", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
            .join(offsets, F.col(key).eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at")))
            .withColumn(out, F.explode(F.sequence(F.col("_offset") + F.col("_first") + 1,
                                                  F.col("_offset") + F.col("_first") + F.col("_copies")))))
    return cool.unionByName(laid.select(*cols, out))


def prefix_before(df: DataFrame, part_cols: list[str], order_col: str, value: Column | str,
                  out_col: str) -> DataFrame:
    """Running sum of ``value`` over rows strictly before the current one in ``order_col``,
    inside ``part_cols`` partitions (which always include the bucket)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*part_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    v = F.col(value) if isinstance(value, str) else value
    return df.withColumn(out_col, F.coalesce(F.sum(v).over(w), F.lit(0)))
