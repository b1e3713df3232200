"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words. Document rates are the solution of the entropy
balancing problem: of all rates between 0 and ``max_copies`` that give every source its target,
those nearest to 1 in relative entropy. They are exponential tilts of the document's size,
``rate = min(max_copies, exp(lambda_s * size / mean_size_s))``, where the multipliers solve the
convex dual. The dual needs documents only through the counts per (source, size), so these are
aggregated once and every Newton iteration is a join and an aggregate over that small table.
Rates are then rounded into whole copies by cumulative rounding over the sizes of a source,
longest first, which keeps a source's words within about one document of its target; a few more
copies (or fewer) of shorter documents make up most of that remainder.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a
document of size 0 takes nothing; an empty table gives an empty result; repeated rows count and
are rated one by one; columns besides id, source and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import WORD, distributed_rank, free_name, text_of
from tabflow.session import checkpoint_dir
from tabflow.sources.io import materialize

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: A source's multiplier is done when its words are this near to the target (as a share of it).
TOLERANCE = 1e-9
MAX_ITERATIONS = 80
#: Rounds that make up what whole copies leave of a target.
SETTLE_ROUNDS = 3


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``_skey`` (a non-null key of the source), ``_size`` and ``_hash``."""
    return (docs
            .withColumn("_skey", F.when(F.col(source_col).isNull(), F.lit("n"))
                        .otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string"))))
            .withColumn("_size", F.regexp_count(text_of(text_col), F.lit(WORD)).cast("bigint"))
            .withColumn("_hash", F.xxhash64(F.col(id_col), F.col(text_col))))


def source_targets(classes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source its size and target from counts per (source, size).

    Shares go by weight; a source stops at ``max_copies`` times its size and the excess is
    reshared among the others by weight until none is above. Each round is one aggregate over the
    table of sources."""
    per = classes.groupBy("_skey").agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size"),
                                       F.sum("_n").alias("_docs"))
    # 's...' before 'n' and code point order inside, so nulls come last
    order = Window.orderBy(F.col("_skey") == "n", "_skey")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = materialize(per.withColumn("_w", weight)
                      .withColumn("_cap", (F.col("source_size") * max_copies).cast("double")), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        held = F.col("_cap") < F.col("_w") * level
        got = per.agg(F.count_if(held), F.sum(F.when(held, F.col("_cap"))),
                      F.sum(F.when(~held, F.col("_w")))).first()
        if got[0] == full or not got[2]:
            break
        full, level = got[0], (total - (got[1] or 0.0)) / got[2]
    return per.withColumn("target", F.least("_cap", F.col("_w") * F.lit(level))).drop("_w")


def multipliers(classes: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Newton iterations on the dual: (_skey, _lambda, _mean), one multiplier per source.

    Below a multiplier of 0 the dual's gradient is convex and Newton steps approach its root from
    one side; above, where the cap bends it, a step that leaves the bracket is replaced by halving
    it. Sums are decimals, so they do not depend on the order of addition and reruns agree."""
    checkpoint_dir(classes.sparkSession)
    top = math.log(max_copies)
    spread = classes.filter("_size > 0").groupBy("_skey").agg(F.min("_size").alias("_least"))
    state = (targets.join(spread, "_skey")
             .withColumn("_mean", F.col("source_size") / F.col("_docs"))
             .withColumn("_full", F.col("target") >= F.col("_cap") * (1 - 1e-12))
             .withColumn("_high", F.when(F.col("target") > F.col("source_size"),
                                         F.lit(top * 1.0000001) * F.col("_mean") / F.col("_least"))
                         .otherwise(F.lit(0.0)))
             .withColumn("_low", F.when(F.col("target") > F.col("source_size"), F.lit(0.0))
                         .otherwise(F.lit(float("-inf"))))
             .select("_skey", "_mean", "_full", "_low", "_high", F.col("target").alias("_goal"),
                     F.when(F.col("_full"), F.col("_high")).otherwise(F.lit(0.0)).alias("_lambda"),
                     F.lit(float("inf")).alias("_error"))
             .checkpoint())
    exact = "decimal(38,9)"
    for _ in range(MAX_ITERATIONS):
        tilt = F.col("_lambda") * F.col("_size") / F.col("_mean")
        words = F.col("_n") * F.col("_size") * F.exp(F.least(tilt, F.lit(top)))
        slope = F.when(tilt < top, words * F.col("_size") / F.col("_mean")).otherwise(F.lit(0.0))
        sums = (classes.filter("_size > 0").join(state.select("_skey", "_lambda", "_mean"), "_skey")
                .groupBy("_skey").agg(F.sum(words.cast(exact)).cast("double").alias("_words"),
                                      F.sum(slope.cast(exact)).cast("double").alias("_slope")))
        excess = F.col("_words") - F.col("_goal")
        low = F.when(excess < 0, F.col("_lambda")).otherwise(F.col("_low"))
        high = F.when(excess > 0, F.col("_lambda")).otherwise(F.col("_high"))
        step = F.col("_lambda") - excess / F.when(F.col("_slope") > 0, F.col("_slope"))
        kept = F.col("_full") | (F.abs(excess) <= TOLERANCE * F.col("_goal"))
        state = (state.join(sums, "_skey")
                 .withColumn("_low", low).withColumn("_high", high)
                 .withColumn("_error", F.when(F.col("_full"), F.lit(0.0)).otherwise(F.abs(excess) / F.col("_goal")))
                 .withColumn("_next", step)
                 .withColumn("_lambda", F.when(kept, F.col("_lambda"))
                             .when(F.col("_next").isNotNull() & (F.col("_next") > F.col("_low"))
                                   & (F.col("_next") < F.col("_high")), F.col("_next"))
                             .otherwise((F.col("_low") + F.col("_high")) / 2))
                 .select("_skey", "_mean", "_full", "_low", "_high", "_goal", "_lambda", "_error")
                 .checkpoint())
        worst = state.agg(F.max("_error")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("_skey", "_lambda", "_mean")


def _settle(classes: DataFrame, max_copies: int, rounds: int) -> DataFrame:
    """What rounding left of each source's target, in words, is made up by more (or fewer) copies
    of classes that are not longer than the remainder, longest first, as far as each has them."""
    before = Window.partitionBy("_skey").orderBy(F.desc("_size")).rowsBetween(Window.unboundedPreceding, -1)
    for _ in range(rounds):
        classes = materialize(classes, "mix-copies")
        left = classes.groupBy("_skey").agg(
            (F.first("target") - F.sum(F.col("_size") * F.col("_copies"))).alias("_left"))
        room = F.when(F.col("_left") > 0, F.col("_n") * max_copies - F.col("_copies")).otherwise(F.col("_copies"))
        fits = (F.col("_size") > 0) & (F.col("_size") <= F.abs("_left"))
        rest = F.abs("_left") - F.coalesce(F.sum(F.col("_spare") * F.col("_size")).over(before), F.lit(0))
        by = F.greatest(F.lit(0), F.least(F.col("_spare"), F.floor(rest / F.greatest("_size", F.lit(1)))))
        classes = (classes.join(left, "_skey").withColumn("_spare", F.when(fits, room).otherwise(0))
                   .withColumn("_copies", (F.col("_copies") + F.signum("_left") * by).cast("bigint"))
                   .drop("_left", "_spare"))
    return materialize(classes, "mix-copies")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken``
    (``copies * size``) added (a clashing column of the input is replaced). Rows of one
    (source, size) have one rate; those that get the extra copy are chosen by a hash of id and
    text."""
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    names = docs.columns
    # numbered names inside, so that no column of the input clashes with those used here
    inner = dict(zip(names, (f"c{i}" for i in range(len(names))), strict=True))
    id_col = inner[id_col]
    rows = _sized(docs.toDF(*inner.values()), id_col, inner[source_col], inner[text_col])
    classes = materialize(rows.groupBy("_skey", "_size").agg(F.count(F.lit(1)).alias("_n")), "mix-classes")
    targets = source_targets(classes, weights, max_copies)
    tilts = multipliers(classes, targets, max_copies)
    longest_first = Window.partitionBy("_skey").orderBy(F.desc("_size")).rowsBetween(
        Window.unboundedPreceding, 0)
    rated = (classes.join(targets.select("_skey", "source_size", "target"), "_skey")
             .join(tilts, "_skey", "left")
             .withColumn("rate", F.when(F.col("_size") == 0, F.lit(0.0)).otherwise(F.exp(F.least(
                 F.lit(math.log(max_copies)), F.col("_lambda") * F.col("_size") / F.col("_mean")))))
             .withColumn("_due", F.sum((F.col("_n") * F.col("rate")).cast("decimal(38,9)")).over(longest_first)
                         + F.lit(0.5)))
    previous = F.lag("_due", 1, 0.5).over(Window.partitionBy("_skey").orderBy(F.desc("_size")))
    allotted = (rated.withColumn("_copies", F.least(F.floor("_due") - F.floor(previous), F.col("_n") * max_copies)
                                 .cast("bigint"))
                .select("_skey", "_size", "_n", "_copies", "rate", "source_size", "target"))
    allotted = _settle(allotted, max_copies, SETTLE_ROUNDS)
    ranked = distributed_rank(rows, ["_skey", "_size"], "_hash", [id_col], "_rank", allotted)
    floor_copies = F.floor(F.col("_copies") / F.col("_n"))
    more = F.when(F.col("_rank") < F.pmod(F.col("_copies"), F.col("_n")), 1).otherwise(0)
    return (ranked.withColumn("copies", (floor_copies + more).cast("bigint"))
            .withColumn("size", F.col("_size"))
            .withColumn("taken", F.col("copies") * F.col("_size"))
            .select(*[F.col(c).alias(name) for name, c in inner.items()], *added))
