"""Similarity join of documents on the Jaccard similarity of their word shingles.

Sets of hashed shingles are put into one order over the corpus, rare first (shingles are counted in
hashed counters over all documents; any common order keeps the join exact). Two sets that are similar
enough share a shingle among the first ``n - ceil(t * n) + 1`` of each, so only these prefixes are
joined. A pair must pass the length filter, the positional filter (what stands behind the common
shingle in the shorter rest must suffice) and the suffix filter (sets are split into ``PARTS``
parts by hash; two sets share at most the smaller of each part), and is then verified once on the
whole texts. In large sets parts of many members agree by chance, so what is left after the first
verification passes the suffix filter again with parts of about four members before texts move.

Equal sets are one node from the start. To find the classes of linked documents not every pair is
needed: first every prefix shingle links its documents to one hub, which is linear in its documents;
then all remaining candidate pairs, those whose documents are still in different classes, are
verified. Pairs inside one class cannot change it. So large groups of copies never become all pairs
and no link between classes is lost.

Defined results: texts without words (null, empty, blank) have no shingles, are linked with nothing
and are their own class; texts with fewer words than a shingle have one shingle, all their words;
repeated rows are linked; a null id joins a class but does not name it (a class of null ids has a
null name); an empty table gives an empty result; texts of any length are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import WORD, delete_table, free_name, lean, text_of
from tabflow.llm.components import components
from tabflow.llm.pretokens import column_batches
from tabflow.sources.io import materialize, run_path

WORDS = 4
PERCENT = 85
#: Counters that give the order of shingles (top bits of the hash); their number is fixed.
COUNTER_BITS = 18
#: Parts of the suffix filter.
PARTS = 64
#: Documents of a block whose remaining pairs are filtered as a matrix.
BLOCK = 1024
#: Documents that are verified against one copy of a hub's text.
PER_COPY = 256
_MUL = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, at most ``limit`` kept."""

    limit = 1 << 17

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_WORDS = _Words()


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; A-Z are lowered, words are
    separated by ASCII white space."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    k = min(words, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, np.uint64)
    for i in range(k):
        s = s * _MUL + h[i:i + n]
    s ^= s >> np.uint64(31)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(29)
    return np.unique(s)


def _node(s: np.ndarray) -> int:
    """A set's name: a signed 64-bit digest of its members."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _parts(s: np.ndarray) -> bytes | None:
    """How many members each part has (None where a count doesn't fit: no suffix filter)."""
    counts = np.bincount((s & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS)
    return counts.astype(np.uint16).tobytes() if counts.max(initial=0) < 65536 else None


def _fine(s: np.ndarray) -> bytes | None:
    """The same with parts of about four members, at most 4,096 parts, for sets that ``PARTS`` parts
    serve badly (None for small sets, and where a count doesn't fit)."""
    if len(s) <= 4 * PARTS:
        return None
    parts = 256 if len(s) <= 1024 else 1024 if len(s) <= 4096 else 4096
    counts = np.bincount((s & np.uint64(parts - 1)).astype(np.int64), minlength=parts)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def enough(inter: int, n: int, m: int, percent: int) -> bool:
    return 100 * inter >= percent * (n + m - inter)


_STATS = "id {id}, tkey bigint, n bigint, node bigint, parts binary, fine binary, slot int, count bigint"


def _statistics(docs: DataFrame, words: int) -> DataFrame:
    """One pass over the texts: a row for each document, and each task's counters of shingles."""
    schema = _STATS.format(id=docs.schema["id"].dataType.simpleString())

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, id_type = np.zeros(1 << COUNTER_BITS, np.int64), pa.null()
        for block in blocks:
            id_type = block.column(0).type
            for lo, hi in column_batches(block.column(2)):
                sizes, nodes, parts, fine, slots = [], [], [], [], []
                for text in block.column(2).slice(lo, hi - lo).to_pylist():
                    s = shingles(text, words)
                    slots.append((s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64))
                    sizes.append(len(s))
                    nodes.append(_node(s) if len(s) else None)
                    parts.append(_parts(s) if len(s) else None)
                    fine.append(_fine(s))
                counters += np.bincount(np.concatenate(slots), minlength=len(counters))
                k = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [block.column(0).slice(lo, k), block.column(1).slice(lo, k), pa.array(sizes, pa.int64()),
                     pa.array(nodes, pa.int64()), pa.array(parts, pa.binary()), pa.array(fine, pa.binary()),
                     pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())],
                    names=["id", "tkey", "n", "node", "parts", "fine", "slot", "count"])
        used = np.flatnonzero(counters)
        if len(used):
            k = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, id_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array(used, pa.int32()), pa.array(counters[used])],
                names=["id", "tkey", "n", "node", "parts", "fine", "slot", "count"])

    return materialize(docs.mapInArrow(lean(run), schema), "jaccard-stats")


def _postings(docs: DataFrame, order: np.ndarray, words: int, percent: int) -> DataFrame:
    """(token, node, place): each set's prefix; ``place`` holds its size and the position. A task
    emits a set once, however many copies it has."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for block in blocks:
            for lo, hi in column_batches(block.column(2)):
                tokens, nodes, places = [], [], []
                for text in block.column(2).slice(lo, hi - lo).to_pylist():
                    s = shingles(text, words)
                    n = len(s)
                    if not n or (node := _node(s)) in seen:
                        continue
                    seen.add(node)
                    # s is sorted, so a stable sort by counter orders by (counter, hash)
                    by = np.argsort(order[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)], kind="stable")
                    prefix = n - -(-percent * n // 100) + 1
                    tokens.append(s[by[:prefix]].view(np.int64))
                    nodes.append(np.full(prefix, node, np.int64))
                    places.append((n << 32) + np.arange(prefix))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (tokens, nodes, places)], names=["token", "node", "place"])

    return docs.mapInArrow(lean(run), "token bigint, node bigint, place bigint")


def _may_match(p: str, q: str, percent: int) -> Column:
    """Length and positional filter of two postings' places."""
    n, m = (F.shiftright(c, 32) for c in (p, q))
    i, j = (F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in (p, q))
    most = F.least(n - i, m - j)
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & ((100 + percent) * most >= percent * (n + m)))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once, whichever of the two is the hub."""
    return (pairs.groupBy(F.least("hub", "node").alias("_a"), F.greatest("hub", "node").alias("_b"))
            .agg(F.min("hub").alias("hub"))
            .select("hub", F.when(F.col("hub") == F.col("_a"), F.col("_b")).otherwise(F.col("_a")).alias("node")))


def _suffix_filter(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, node) that the parts' counts allow."""
    of = nodes.select("node", "n", "parts")
    both = (pairs.join(of, "node")
            .join(of.select(F.col("node").alias("hub"), F.col("n").alias("m"), F.col("parts").alias("hub_parts")), "hub")
            .select("hub", "node", "n", "m", "parts", "hub_parts"))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            n, m = (block.column(i).to_numpy() for i in (2, 3))
            keep = np.ones(block.num_rows, bool)
            a, b = block.column(4).to_pylist(), block.column(5).to_pylist()
            known = [i for i in range(len(a)) if a[i] is not None and b[i] is not None]
            if known:
                x, y = (np.frombuffer(b"".join(v[i] for i in known), np.uint16).reshape(-1, PARTS) for v in (a, b))
                most = np.minimum(x, y).sum(1, dtype=np.int64)
                keep[known] = (100 + percent) * most >= percent * (n[known] + m[known])
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in block.columns[:2]], names=["hub", "node"])

    return both.mapInArrow(lean(run), "hub bigint, node bigint")


def _fine_filter(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, node) that the counts of small parts allow. Of two numbers of parts the larger one is
    folded: parts are the lowest bits of a hash."""
    of = nodes.select("node", "n", "fine")
    both = (pairs.join(of, "node")
            .join(of.select(F.col("node").alias("hub"), F.col("n").alias("m"), F.col("fine").alias("hub_fine")), "hub")
            .select("hub", "node", "n", "m", "fine", "hub_fine"))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            keep = np.ones(block.num_rows, bool)
            n, m = (block.column(i).to_numpy() for i in (2, 3))
            for i, (a, b) in enumerate(zip(block.column(4), block.column(5), strict=True)):
                if a.is_valid and b.is_valid:
                    x, y = sorted((np.frombuffer(v.as_buffer(), np.uint8) for v in (a, b)), key=len)
                    most = int(np.minimum(x, y.reshape(-1, len(x)).sum(0, dtype=np.int64)).sum(dtype=np.int64))
                    keep[i] = (100 + percent) * most >= percent * (n[i] + m[i])
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in block.columns[:2]], names=["hub", "node"])

    return both.mapInArrow(lean(run), "hub bigint, node bigint")


def _remaining(side: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """All pairs (hub, node) of different classes that share a prefix shingle and pass the length and
    suffix filters, from (token, node, comp, cluster).

    Shingles with the same hub form a cluster; two documents that share a shingle share its
    cluster, and a pair is listed in the least cluster that they share. In a cluster only strays,
    those outside its hub's class, have pairs left: with each other and with the class. Both are cut
    into blocks and each pair of blocks is a unit of its own, which is filtered as a matrix; rows
    travel once for each unit, and only the pairs that pass leave it."""
    at = (side.select("node", "comp", "cluster").distinct()
          .join(side.filter(F.col("node") == F.col("cluster")).select("cluster", F.col("comp").alias("main")).distinct(),
                "cluster", "left")
          .withColumn("stray", F.coalesce(F.col("comp") != F.col("main"), F.lit(True))))
    sizes = at.groupBy("cluster").agg(F.count_if("stray").alias("_s"), F.count_if(~F.col("stray")).alias("_m")).select(
        "cluster", F.ceil(F.col("_s") / BLOCK).cast("int").alias("bs"), F.ceil(F.col("_m") / BLOCK).cast("int").alias("bm"))
    of = (nodes.select("node", "n", "parts")
          .join(at.groupBy("node").agg(F.sort_array(F.collect_set("cluster")).alias("clusters")), "node"))
    whole = (at.join(sizes.filter("bs > 0"), "cluster")
             .withColumn("b", F.pmod(F.xxhash64("node"), F.when(F.col("stray"), F.col("bs")).otherwise(F.col("bm"))).cast("int")))
    each = F.sequence(F.lit(0), F.col("bs") - 1)
    strays = whole.filter("stray")
    units = (strays.withColumn("o", F.explode(each))  # strays with strays
             .select("node", "comp", "cluster", F.lit(0).alias("kind"), F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"),
                     (F.col("b") > F.col("o")).cast("int").alias("right"))
             .unionByName(strays.filter("bm > 0").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("bm") - 1)))
                          .select("node", "comp", "cluster", F.lit(1).alias("kind"), F.col("b").alias("i"), F.col("o").alias("j"),
                                  F.lit(0).alias("right")))
             .unionByName(whole.filter("not stray").withColumn("o", F.explode(each))
                          .select("node", "comp", "cluster", F.lit(1).alias("kind"), F.col("o").alias("i"), F.col("b").alias("j"),
                                  F.lit(1).alias("right"))))
    sent = (units.join(of, "node").repartition("cluster", "kind", "i", "j")
            .sortWithinPartitions("cluster", "kind", "i", "j")
            .select("cluster", "kind", "i", "j", "right", "node", "comp", "n", "parts", "clusters"))

    def pairs_of(unit: list) -> Iterator[tuple[int, int]]:
        cluster, kind, i, j = unit[0][:4]
        one_block = kind == 0 and i == j
        left = unit if one_block else [r for r in unit if r[4] == 0]
        right = unit if one_block else [r for r in unit if r[4] == 1]
        if not left or not right:
            return
        blank = bytes(2 * PARTS)  # counts that are not known exclude nothing
        unknown = np.array([r[8] is None for r in right])
        x = np.frombuffer(b"".join(r[8] or blank for r in right), np.uint16).reshape(-1, PARTS)
        n, comp = (np.array([r[k] for r in right], np.int64) for k in (7, 6))
        for k, a in enumerate(left):
            lo = k + 1 if one_block else 0
            most = np.minimum(np.frombuffer(a[8] or blank, np.uint16), x[lo:]).sum(1, dtype=np.int64)
            m = n[lo:]
            ok = ((comp[lo:] != a[6])
                  & (unknown[lo:] | (a[8] is None) | ((100 + percent) * most >= percent * (m + a[7])))
                  & (100 * np.minimum(m, a[7]) >= percent * np.maximum(m, a[7])))
            own = set(a[9].tolist()) if ok.any() else set()
            for h in (np.flatnonzero(ok) + lo).tolist():
                b = right[h]
                if next(c for c in b[9].tolist() if c in own) == cluster:
                    yield min(a[5], b[5]), max(a[5], b[5])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list = []

        def out(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                               pa.array([p[1] for p in found], pa.int64())], names=["hub", "node"])

        for block in blocks:
            found = []
            # the clusters stay numbers of 8 bytes: as objects they would be most of the worker's memory
            clusters, ends = block.column(9).flatten().to_numpy(), np.diff(block.column(9).offsets.to_numpy()).cumsum()
            of_row = np.split(clusters, ends[:-1])
            for row in zip(*(c.to_pylist() for c in block.columns[:9]), of_row, strict=True):
                if unit and unit[0][:4] != row[:4]:
                    found += pairs_of(unit)
                    unit = []
                unit.append(row)
            yield out(found)
        if unit:
            yield out(list(pairs_of(unit)))

    return sent.mapInArrow(lean(run), "hub bigint, node bigint")


def _verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (hub, node) that are similar. Each document of a pair comes once with its text to
    its hub; a hub with many partners comes in several copies."""
    copies = (pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("_k"))
              .select("hub", F.ceil(F.col("_k") / PER_COPY).cast("int").alias("copies")))
    members = pairs.join(copies, "hub").select(
        "node", "hub", F.pmod(F.xxhash64("node"), "copies").cast("int").alias("copy"), F.lit(1).alias("role"))
    centres = copies.select(F.col("hub").alias("node"), "hub",
                            F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("role"))
    wanted = members.unionByName(centres).join(
        nodes.select("node", F.col("rep.id").alias("_id"), F.col("rep.tkey").alias("_tkey")), "node")
    sent = (docs.join(wanted, docs["id"].eqNullSafe(wanted["_id"]) & (docs["tkey"] == wanted["_tkey"]))
            .select("hub", "copy", "role", "node", "text")
            .repartition("hub", "copy").sortWithinPartitions("hub", "copy", "role", "node"))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre, last = None, np.zeros(0, np.uint64), None
        for block in blocks:
            hubs, found = [], []
            for hub, copy, role, node, text in zip(*(block.column(i).to_pylist() for i in range(4)), block.column(4),
                                                   strict=True):
                if role == 0:
                    if (hub, copy) != at:
                        at, centre, last = (hub, copy), shingles(text.as_py(), words), None
                    continue
                if node == last:  # a repeated row
                    continue
                last = node
                s = shingles(text.as_py(), words)
                common = len(np.intersect1d(centre, s, assume_unique=True))
                if enough(common, len(centre), len(s), percent):
                    hubs.append(hub)
                    found.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(found, pa.int64())], names=["hub", "node"])

    return sent.mapInArrow(lean(run), "hub bigint, node bigint")


def _classes(rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """From (id, tkey, text): (documents, nodes). Documents: (id, tkey, n, node), without a node
    where there is no shingle; nodes: (node, label, least), ``label`` names the class."""
    stats = _statistics(rows, words)
    order = np.zeros(1 << COUNTER_BITS, np.int64)
    # one row a counter: a number that is fixed whatever the corpus
    for slot, count in (stats.filter("slot is not null").groupBy("slot").agg(F.sum("count")).toPandas()
                        .itertuples(index=False)):
        order[slot] = count
    order = np.argsort(np.argsort(order, kind="stable"), kind="stable").astype(np.int32)
    of_docs = stats.filter("n is not null").select("id", "tkey", "n", "node", "parts", "fine")
    nodes = materialize(of_docs.filter("node is not null").groupBy("node").agg(
        F.min("n").alias("n"), F.min("parts").alias("parts"), F.min("fine").alias("fine"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tkey")).alias("rep"),
        F.min("id").alias("least")), "jaccard-nodes")

    spark, prefixes = rows.sparkSession, run_path(rows.sparkSession, "jaccard-prefixes")
    _postings(rows, order, words, percent).write.parquet(prefixes)
    postings = spark.read.parquet(prefixes)
    shared = postings.groupBy("token").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).filter(
        "_low <> _high").select("token")
    common = materialize(postings.join(shared, "token").distinct(), "jaccard-postings")
    delete_table(spark, prefixes)  # the shared ones are written
    # a shingle's hub is the document that shares most: near copies of one text gather around the
    # least edited of them
    often = common.groupBy("token").agg(F.count(F.lit(1)).alias("_df"))
    weight = common.join(often, "token").groupBy("node").agg(F.sum("_df").alias("weight"))
    hubs = common.join(weight, "node").groupBy("token").agg(F.max(F.struct("weight", "node", "place")).alias("hub"))
    held = materialize(common.join(hubs, "token"), "jaccard-hubs")

    # every document of a shingle with its hub: linear in the prefixes
    pairs = (held.filter(F.col("node") != F.col("hub.node")).withColumn("_q", F.col("hub.place"))
             .filter(_may_match("place", "_q", percent)).select(F.col("hub.node").alias("hub"), "node"))
    tried = materialize(_suffix_filter(_once(pairs), nodes, percent), "jaccard-pairs")
    links = materialize(_verify(tried, rows, nodes, words, percent), "jaccard-links")
    labels = components(links, "hub", "node")

    # what is left: candidate pairs whose documents are still in different classes
    side = (held.withColumn("cluster", F.col("hub.node")).drop("hub")
            .join(labels.select("node", F.col("label").alias("_l")), "node", "left")
            .withColumn("comp", F.coalesce("_l", "node")).drop("_l"))
    mixed = side.groupBy("token").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high")).filter(
        "_low <> _high").select("token")
    side = materialize(side.join(mixed, "token"), "jaccard-mixed")
    if not side.isEmpty():
        back = tried.select(F.col("node").alias("hub"), F.col("hub").alias("node"))
        more = _once(_remaining(side, nodes, percent)).join(tried.unionByName(back), ["hub", "node"], "left_anti")
        more = materialize(_fine_filter(more, nodes, percent), "jaccard-pairs")
        if not more.isEmpty():
            links = links.unionByName(materialize(_verify(more, rows, nodes, words, percent), "jaccard-links"))
            labels = components(links, "hub", "node")

    of_nodes = nodes.select("node", "least", "rep").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    return of_docs.drop("parts", "fine"), materialize(of_nodes, "jaccard-classes")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tkey"), text_of(text_col).alias("text"))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                   percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id): ``component_id`` is the smallest id in a row's class."""
    of_docs, nodes = _classes(_rows(docs, id_col, text_col), words, percent)
    names = nodes.groupBy("label").agg(F.min("least").alias("component_id"))
    own = nodes.join(names, "label").select("node", "component_id")
    return (of_docs.join(own, "node", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
             percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one with the smallest id (ids that are null
    only where the class has no other), and every row without a word. Columns are kept."""
    _, nodes = _classes(_rows(docs, id_col, text_col), words, percent)
    best = nodes.groupBy("label").agg(F.min(F.struct(F.col("rep.no_id"), F.col("rep.id"), F.col("rep.tkey"))).alias("r"))
    key = free_name(docs, "_stays")
    stays = best.select(F.xxhash64("r.id", "r.tkey").alias(key))
    wordless = ~text_of(text_col).rlike(WORD)
    keyed = docs.filter(~wordless).withColumn(key, F.xxhash64(F.col(id_col), F.xxhash64(text_col)))
    # a repeated row is one of its class too
    return (keyed.join(stays, key, "left_semi").dropDuplicates([key]).drop(key)
            .unionByName(docs.filter(wordless)))
