"""Sharding by balanced label propagation.

Documents with equal texts are linked. Large groups (``HOT_PARTS`` or fewer of them would fill a
shard) are seated first, the largest first: whole in the fullest shard that still has room for all
of it, else shard by shard from the one with most room. Every other document starts in a shard
chosen by its hash, in proportion to the places left; in each round linked documents ask to move to the shard where most of their neighbours are, and
quotas per (from, to) pair admit only what keeps every shard within its share: what two shards
exchange evenly, and what fits into free room. Documents of one group in one shard are
interchangeable, so the rounds work on counts per (group, shard), never on pairs of documents.
Groups that are still split when nothing moves, or that are beyond a shard's places, are taken out
and laid one after the other into the free places; the few that would lie across the end of a shard
are seated like the large ones. Documents without links fill the remaining places, so the numbers
of rows differ by one at most (law ``rows``). A group is split only if, when it is seated, it
exceeds the room left in every shard.

Defined results: a null text counts as an empty one (and is linked to empty texts); repeated rows
are separate rows; an empty table gives an empty result; a null id is a value like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import distributed_rank, text_of
from tabflow.session import checkpoint_dir
from tabflow.sources.io import materialize

SHARDS = 8
MAX_ROUNDS = 8
#: Groups of at least this part of a shard are seated first, so at most ``HOT_PARTS`` a shard.
HOT_PARTS = 64
_BITS = 10


def _quotas(spark, places: list[int]) -> DataFrame:
    """(shard, _quota) of a list of places by shard."""
    return (spark.range(len(places)).select(F.col("id").cast("int").alias("_shard"))
            .withColumn("_quota", F.element_at(F.array(*[F.lit(p).cast("bigint") for p in places]), F.col("_shard") + 1)))


def _seat(groups: list[tuple[bytes, int]], room: list[int]) -> list[tuple[bytes, int, int]]:
    """(group, shard, n) of (group, n), the largest first; ``room`` by shard is used up."""
    cells = []
    for group, n in sorted(groups, key=lambda g: (-g[1], g[0])):
        while n:
            whole = [s for s in range(len(room)) if room[s] >= n]
            s = min(whole, key=lambda s: room[s]) if whole else max(range(len(room)), key=lambda s: room[s])
            take = min(n, room[s])
            cells.append((group, s, take))
            room[s] -= take
            n -= take
    return cells


def _literal_cells(spark, cells: list[tuple[bytes, int, int]]) -> DataFrame:
    """(_group, _shard, _n) of a short list."""
    kind = "array<struct<_group:binary,_shard:int,_n:bigint>>"
    each = [F.struct(F.lit(g).alias("_group"), F.lit(s).alias("_shard"), F.lit(n).cast("bigint").alias("_n")) for g, s, n in cells]
    return spark.range(1).select(F.inline((F.array(*each) if each else F.array()).cast(kind)))


def _until(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_until``: the running sum of ``_n`` within ``keys`` by the groups' hash, in two levels."""
    ranged = (rows.withColumn("_order", F.xxhash64("_group"))
              .withColumn("_range", F.shiftrightunsigned("_order", 64 - _BITS).cast("int")))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_sum"))
               .withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum"))
    inside = Window.partitionBy(*keys, "_range").orderBy("_order", "_group").rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(offsets, [*keys, "_range"]).withColumn("_until", F.sum("_n").over(inside) + F.col("_offset"))
            .drop("_order", "_range", "_offset"))


def _settle(cells: DataFrame, places: list[int]) -> DataFrame:
    """Cells after the rounds, with groups whole and shards within ``places``."""
    spark, shards = cells.sparkSession, len(places)
    groups = cells.groupBy("_group").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_cells"), F.min("_shard").alias("_shard"))
    quotas = _quotas(spark, places)
    seated = materialize(_until(groups.filter("_cells = 1"), ["_shard"]).join(quotas, "_shard")
                         .withColumn("_stays", F.col("_until") <= F.col("_quota"))
                         .select("_group", "_shard", "_n", "_stays"), "shard-groups")
    kept = seated.filter("_stays").select("_group", "_shard", "_n")
    room = list(places)
    for shard, used in kept.groupBy("_shard").agg(F.sum("_n")).collect():  # one row per shard
        room[shard] -= used
    lifted = seated.filter(~F.col("_stays")).select("_group", "_n").unionByName(
        groups.filter("_cells > 1").select("_group", "_n"))
    target, at = F.lit(None).cast("int"), 0
    for s in sorted(range(shards), key=lambda s: (-room[s], s)):
        target = F.when((F.col("_until") - F.col("_n") >= at) & (F.col("_until") <= at + room[s]), F.lit(s)).otherwise(target)
        at += room[s]
    laid = materialize(_until(lifted.withColumn("_all", F.lit(0)), ["_all"])
                       .select("_group", target.alias("_shard"), "_n"), "shard-laid")
    whole = laid.filter("_shard is not null")
    for shard, used in whole.groupBy("_shard").agg(F.sum("_n")).collect():
        room[shard] -= used
    # one group at most across the end of each shard
    across = [(bytes(g), n) for g, n in laid.filter("_shard is null").select("_group", "_n").collect()]
    return kept.unionByName(whole).unionByName(_literal_cells(spark, _seat(across, room)))


def _round(cells: DataFrame, quotas: DataFrame) -> tuple[DataFrame, int]:
    """One round: (cells after it, documents that moved)."""
    best = cells.groupBy("_group").agg(
        F.max_by("_shard", F.struct("_n", F.xxhash64("_group", "_shard"))).alias("_to"))
    wishes = materialize(cells.join(best, "_group"), "shard-wishes")
    asked = (wishes.filter("_shard <> _to").groupBy("_shard", "_to").agg(F.sum("_n").alias("_asked")))
    back = asked.select(F.col("_shard").alias("_to"), F.col("_to").alias("_shard"),
                        F.col("_asked").alias("_back"))
    load = wishes.groupBy(F.col("_shard").alias("_to")).agg(F.sum("_n").alias("_load"))
    room = (quotas.withColumnRenamed("_shard", "_to").join(load, "_to", "left")
            .select("_to", F.greatest(F.lit(0), F.col("_quota") - F.coalesce("_load", F.lit(0))).alias("_room")))
    pair = Window.partitionBy("_to")
    admitted = (asked.join(back, ["_shard", "_to"], "left").join(room, "_to")
                .withColumn("_swap", F.least("_asked", F.coalesce("_back", F.lit(0))))
                .withColumn("_rest", F.col("_asked") - F.col("_swap"))
                .withColumn("_all_rest", F.sum("_rest").over(pair))
                .withColumn("_more", F.when(F.col("_all_rest") <= F.col("_room"), F.col("_rest"))
                            .otherwise(F.floor(F.col("_rest") / F.col("_all_rest") * F.col("_room"))))
                .select("_shard", "_to", (F.col("_swap") + F.col("_more")).cast("bigint").alias("_admit")))
    # first come by hash: running sums of the documents that ask, in two levels
    movers = (wishes.filter("_shard <> _to")
              .withColumn("_order", F.xxhash64("_group"))
              .withColumn("_range", F.shiftrightunsigned("_order", 64 - _BITS).cast("int")))
    before = Window.partitionBy("_shard", "_to").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (movers.groupBy("_shard", "_to", "_range").agg(F.sum("_n").alias("_sum"))
              .withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
              .join(admitted, ["_shard", "_to"]).drop("_sum"))
    inside = Window.partitionBy("_shard", "_to", "_range").orderBy("_order", "_group").rowsBetween(
        Window.unboundedPreceding, 0)
    moved = (movers.join(ranges, ["_shard", "_to", "_range"])
             .withColumn("_before", F.sum("_n").over(inside) - F.col("_n") + F.col("_offset"))
             .withColumn("_moved", F.greatest(F.lit(0), F.least(F.col("_n"), F.col("_admit") - F.col("_before"))))
             .filter("_moved > 0").select("_group", "_shard", "_to", "_moved"))
    moved = materialize(moved, "shard-moves")
    count = moved.agg(F.sum("_moved")).first()[0] or 0
    if not count:
        return wishes.select("_group", "_shard", "_n"), 0
    after = (wishes.select("_group", "_shard", "_n")
             .unionByName(moved.select("_group", "_shard", (-F.col("_moved")).alias("_n")))
             .unionByName(moved.select("_group", F.col("_to").alias("_shard"), F.col("_moved").alias("_n")))
             .groupBy("_group", "_shard").agg(F.sum("_n").alias("_n")).filter("_n > 0"))
    return materialize(after, "shard-cells"), count


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shards: int = SHARDS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot): one row per row of ``docs``; ``size`` is the
    text's UTF-8 bytes plus 1, ``slot`` counts from 0 without gaps inside a shard."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    text = text_of(text_col)
    rows = materialize(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("bigint").alias("_size"),
        F.crc32(text).alias("_crc"), F.unhex(F.md5(text)).alias("_group"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("_hash")), "shard-rows")
    n = rows.count()
    # rows a shard holds in the end; they differ by one at most
    places = [n // shards + (s < n % shards) for s in range(shards)]
    quotas = _quotas(spark, places)
    sizes = materialize(rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_all")).filter("_all > 1"), "shard-sizes")
    hot = F.col("_all") * HOT_PARTS >= places[0]
    left = list(places)  # what the large groups, a bounded number, leave to the others
    large = _literal_cells(spark, _seat([(bytes(g), k) for g, k in sizes.filter(hot).collect()], left))
    first, at = F.lit(shards - 1), sum(left)
    for s in reversed(range(shards)):
        first, at = F.when(F.col("_at") < at, F.lit(s)).otherwise(first), at - left[s]
    cells = materialize(rows.join(sizes.filter(~hot).select("_group"), "_group", "left_semi")
                        .withColumn("_at", F.pmod("_hash", F.lit(max(1, sum(left)))))
                        .groupBy("_group", first.cast("int").alias("_shard")).agg(F.count(F.lit(1)).alias("_n")), "shard-cells")
    for _ in range(rounds):
        cells, moved = _round(cells, _quotas(spark, left))
        if not moved:
            break
    cells = _settle(cells, left).unionByName(large)
    # a group's documents, in hash order, take its places shard by shard
    until = F.expr("transform(_cells, (c, i) -> named_struct('shard', c._shard, 'until', "
                   "aggregate(slice(_cells, 1, i + 1), 0L, (a, x) -> a + x._n)))")
    places = (cells.groupBy("_group").agg(F.sort_array(F.collect_list(F.struct("_shard", "_n"))).alias("_cells"))
              .select("_group", until.alias("_places")))
    linked = rows.join(sizes.select("_group"), "_group", "left_semi")
    labelled = (distributed_rank(linked, ["_group"], "_hash", ["_id"], "_rank", places)
                .withColumn("_label", F.expr("filter(_places, p -> _rank < p.until)[0].shard"))
                .select("_id", "_size", "_crc", "_hash", "_group", "_label"))
    alone = (rows.join(sizes.select("_group"), "_group", "left_anti")
             .select("_id", "_size", "_crc", "_hash", "_group"))
    # places inside a shard go to its linked documents first, which never exceed them
    kept = materialize(distributed_rank(labelled, ["_label"], "_hash", ["_id", "_group"], "_seat"), "shard-seats")
    used = kept.groupBy(F.col("_label").alias("_shard")).agg(F.count(F.lit(1)).alias("_used"))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    free = (quotas.join(used, "_shard", "left").withColumn("_used", F.coalesce("_used", F.lit(0)))
            .withColumn("_free", F.col("_quota") - F.col("_used"))
            .withColumn("_from", F.coalesce(F.sum("_free").over(before), F.lit(0))))
    spans = [tuple(r) for r in free.select("_shard", "_used", "_from").orderBy("_shard").collect()]
    pick = F.lit(None).cast("struct<shard:int,slot:bigint>")
    for shard, taken, start_at in spans:  # one row per shard
        pick = F.when(F.col("_seat") >= start_at, F.struct(
            F.lit(shard).alias("shard"), (F.col("_seat") - start_at + taken).cast("bigint").alias("slot"))
        ).otherwise(pick)
    filled = (distributed_rank(alone, [], "_hash", ["_id", "_group"], "_seat")
              .withColumn("_place", pick)
              .select("_id", "_size", "_crc", F.col("_place.shard").alias("_shard"),
                      F.col("_place.slot").alias("_slot")))
    return (kept.select("_id", "_size", "_crc", F.col("_label").alias("_shard"),
                        F.col("_seat").cast("bigint").alias("_slot"))
            .unionByName(filled)
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"),
                    F.col("_crc").alias("text_crc32"), F.lit("rows").alias("law"),
                    F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
