"""Exact top-k by inner product with norm-bucketed retrieval.

Vectors are sorted by length into buckets of ``BUCKET`` and chunks of ``CHUNK`` buckets; queries are
packed into blocks. First every block meets the chunk of the longest vectors, which gives each
query a threshold, its k-th score so far. Then a block is sent only to chunks that are long enough
to reach the threshold of one of its queries. Inside a chunk each bucket is met with the queries'
local cosine thresholds ``threshold / (|q| * longest)``: above 1 the bucket is skipped; from
``COORDINATE_FROM`` on, candidates are pruned by the ranges that single coordinates of a vector at
that cosine can have; below, by length (buckets are sorted, so a prefix remains). What remains is
verified by exact products in integers.

Defined results: rows with a null id or vector, or with a null or non-finite component take no
part; vectors meet only vectors of as many components; components are floors of ``scale * x``,
clipped to 64 bits, and scores are clipped to 64 bits; every row is a candidate of its own, fully
repeated ones too, and a query leaves out only its own row (of repeated rows, one); an empty table
gives an empty result; fewer candidates than k give fewer rows; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.sources.io import materialize

BUCKET = 1024
CHUNK = 64
QUERY_BLOCK = 512
#: Query blocks that meet a copy of a chunk in one task.
BLOCKS_PER_TASK = 64
COORDINATE_FROM = 0.8
FOCUS = 3
_TOP = np.iinfo(np.int64).max
_PACKED = "dim int, longest double, chunk bigint, seq int, ids binary, marks binary, kind string, vectors binary"


def _components(rows: list, scale: float) -> np.ndarray:
    x = np.floor(np.array(rows, np.float64) * scale)
    big = np.abs(x) >= 2.0 ** 63
    out = np.where(big, 0, x).astype(np.int64)
    out[big] = np.where(x[big] > 0, _TOP, -_TOP)
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """The narrowest integers that hold the array."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype(next(t for t in ("i1", "i2", "i4", "i8") if most <= np.iinfo(t).max))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    top = (int(np.abs(a.astype(object)).max()) if a.size else 0) * (int(np.abs(b.astype(object)).max()) if b.size else 0) \
        if max(a.dtype.itemsize, b.dtype.itemsize) == 8 else \
        (int(np.abs(a.astype(np.int64)).max()) if a.size else 0) * (int(np.abs(b.astype(np.int64)).max()) if b.size else 0)
    if top * a.shape[1] < 2 ** 53:  # every sum is exact in doubles
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -_TOP, _TOP).astype(np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def _packer(size: int, per_chunk: int, scale: float):
    """Rows (id, mark, vector), sorted, to packed rows of ``size`` vectors of one dimension."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list = []

        def pack(rows: list) -> pa.RecordBatch:
            nonlocal seq
            x = _components([r[2] for r in rows], scale).reshape(len(rows), -1)
            narrow = _small(x)
            cols = [pa.array([x.shape[1]], pa.int32()), pa.array([float(_norms(x).max())], pa.float64()),
                    pa.array([part << 32 | seq // per_chunk], pa.int64()), pa.array([seq], pa.int32()),
                    pa.array([np.array([r[0] for r in rows], np.int64).tobytes()], pa.binary()),
                    pa.array([np.array([r[1] for r in rows], np.int64).tobytes()], pa.binary()),
                    pa.array([narrow.dtype.str], pa.string()), pa.array([narrow.tobytes()], pa.binary())]
            seq += 1
            return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _PACKED.split(", ")])

        for block in blocks:
            for row in zip(*(block.column(i).to_pylist() for i in range(3)), strict=True):
                if held and (len(held) == size or len(held[0][2]) != len(row[2])):
                    if len(held[0][2]) != len(row[2]):
                        yield pack(held)
                        seq = -(-seq // per_chunk) * per_chunk  # a chunk has one dimension
                    else:
                        yield pack(held)
                    held = []
                held.append(row)
        if held:
            yield pack(held)

    return run


def _unpack(ids: bytes, marks: bytes, kind: str, vectors: bytes, dim: int) -> tuple:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(marks, np.int64), np.frombuffer(vectors, kind).reshape(len(own), dim)


class Best:
    """The k best (score, id) of each query so far; missing ones have id -1 marked by ``filled``."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -_TOP, np.int64)
        self.ids = np.full((n, k), _TOP, np.int64)
        self.filled = np.zeros(n, np.int64)

    def threshold(self) -> np.ndarray:
        """The k-th score; minus infinity while there are fewer."""
        return np.where(self.filled >= self.k, self.scores[:, -1].astype(np.float64), -np.inf)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        """Offer each of ``rows`` the candidates in the same row of ``scores``."""
        if scores.shape[1] > self.k:
            # order inside the row: score, then smaller id (columns are sorted by id)
            width = scores.shape[1]
            s = np.where(valid, scores, -_TOP)
            if int(np.abs(s[valid]).max(initial=0)) < 2 ** 40:
                s = np.where(valid, scores, -(2 ** 40))
                key = s * width + (width - 1 - np.arange(width))
                keep = np.argpartition(-key, self.k - 1, axis=1)[:, :self.k]
            else:
                keep = np.argsort(-s, axis=1, kind="stable")[:, :self.k]
            scores, valid = np.take_along_axis(scores, keep, 1), np.take_along_axis(valid, keep, 1)
            ids = np.take_along_axis(np.broadcast_to(ids, s.shape), keep, 1)
        else:
            ids = np.broadcast_to(ids, scores.shape)
        all_scores = np.concatenate([self.scores[rows], scores], 1)
        all_ids = np.concatenate([self.ids[rows], ids], 1)
        empty = np.concatenate([np.arange(self.k) >= self.filled[rows, None], ~valid], 1)
        order = np.lexsort((all_ids, -all_scores, empty), axis=1)[:, :self.k]
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)
        self.filled[rows] = np.minimum(self.k, self.filled[rows] + valid.sum(1))


def search(buckets: list, queries: tuple, best: Best, floor: np.ndarray) -> None:
    """Meet a block of queries with buckets (longest first). ``floor``: thresholds known before."""
    q_ids, q_marks, q = queries
    q_norms = _norms(q)
    q_unit = q / np.where(q_norms > 0, q_norms, 1)[:, None]
    for ids, marks, v, norms, unit in buckets:
        if not len(ids):
            continue
        need = np.maximum(best.threshold(), floor)
        reach = q_norms * norms[0]
        # a hair of slack for rounding; what passes is verified in integers
        live = np.flatnonzero(need <= reach * (1 + 1e-9) + 1e-6)
        if not len(live):
            continue
        cosine = np.where(reach[live] > 0, need[live] / np.where(reach[live] > 0, reach[live], 1), -np.inf)
        close = cosine >= COORDINATE_FROM
        for i, t in zip(live[close].tolist(), np.minimum(cosine[close], 1.0).tolist(), strict=True):
            keep = norms * q_norms[i] >= need[i] * (1 - 1e-9) - 1e-6
            for f in np.argsort(-np.abs(q_unit[i]))[:FOCUS]:
                mid = t * q_unit[i, f]
                wide = np.sqrt(max(0.0, (1 - t * t) * (1 - q_unit[i, f] ** 2))) + 1e-6
                # at a cosine above t the range only moves towards the query's own coordinate
                low = -1.0 if q_unit[i, f] <= -t else mid - wide
                high = 1.0 if q_unit[i, f] >= t else mid + wide
                keep &= (unit[:, f] >= low) & (unit[:, f] <= high)
            at = np.flatnonzero(keep)
            if len(at):
                at = at[np.argsort(ids[at], kind="stable")]
                s = products(q[i:i + 1], v[at])
                ok = (s >= need[i]) & ((ids[at] != q_ids[i]) | (marks[at] != q_marks[i]))
                best.add(np.array([i]), s, ids[at][None, :], ok)
        far = live[~close]
        if len(far):
            # lengths are sorted, so those that can reach the threshold are a prefix
            least = np.where(need[far] > 0, need[far] / np.where(q_norms[far] > 0, q_norms[far], 1), 0.0)
            n = int(np.searchsorted(-norms, -(least.min() * (1 - 1e-9) - 1e-6), "right"))
            order = np.argsort(ids[:n], kind="stable")
            s = products(q[far], v[:n][order])
            own = (ids[:n][order][None, :] == q_ids[far, None]) & (marks[:n][order][None, :] == q_marks[far, None])
            ok = (s >= need[far, None]) & ~own
            some = ok.any(axis=1)
            if some.any():
                best.add(far[some], s[some], ids[:n][order][None, :], ok[some])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 1.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row of ``queries`` its k best rows of ``vectors``.

    Vectors move once into range partitions of their length; afterwards packed chunks and query
    blocks move, a copy of a chunk for every ``BLOCKS_PER_TASK`` blocks. A task holds one chunk and
    takes the blocks one after the other."""
    chunks = materialize(_ordered(vectors, id_col, vector_col, scale)
                         .mapInArrow(_packer(BUCKET, CHUNK, scale), _PACKED), "topk-chunks")
    blocks = materialize(_ordered(queries, id_col, vector_col, scale)
                         .mapInArrow(_packer(QUERY_BLOCK, 1, scale), _PACKED), "topk-queries")
    n_blocks = blocks.count()
    salts = max(1, -(-n_blocks // BLOCKS_PER_TASK))
    meta = chunks.groupBy("dim", "chunk").agg(F.max("longest").alias("_reach"))
    longest = meta.groupBy("dim").agg(
        F.min_by("chunk", F.struct((-F.col("_reach")).alias("r"), "chunk")).alias("_chunk"))
    packed = [c.split()[0] for c in _PACKED.split(", ")]
    floors = F.lit(None).cast("binary").alias("floors")

    first = (blocks.join(longest, "dim")
             .select("dim", "longest", F.col("_chunk").alias("chunk"), "seq", "ids", "marks", "kind", "vectors", floors,
                     F.col("chunk").alias("block")))
    got = materialize(_meet(first, chunks.join(longest.select(F.col("_chunk").alias("chunk")), "chunk", "left_semi"),
                            salts, k), "topk-first")
    # the k-th scores after the first pass decide which other chunks a block still needs
    asked = got.filter("kind is not null")
    second = (asked.join(meta.withColumnRenamed("chunk", "_other"), "dim").join(longest, "dim")
              .filter((F.col("_other") != F.col("_chunk")) & (F.col("_reach") >= F.col("need")))
              .select("dim", "longest", F.col("_other").alias("chunk"), "seq", "ids", "marks", "kind", "vectors",
                      "floors", "block"))
    more = _meet(second, chunks.select(*packed), salts, k).filter("kind is null")
    hits = got.filter("kind is null").select("block", "query_id", "mark", "vec_id", "score").unionByName(
        more.select("block", "query_id", "mark", "vec_id", "score"))
    rank = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(rank).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("vec_id").alias(id_col), "score"))


def _ordered(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, mark, vector) of the rows that take part, longest first; ``mark`` tells apart rows of
    one id: fully repeated rows are counted on the map side and numbered, so each stays a row of its
    own. The order by length is what is wanted; ids and numbers split equal lengths among tasks."""
    vector = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = (rows.filter(usable).select(F.col(id_col).cast("bigint").alias("_id"), vector.alias("_vector"))
            .groupBy("_id", "_vector").agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")))
            .withColumn("_mark", F.xxhash64("_vector", "_copy")))
    length = F.aggregate(F.transform("_vector", lambda x: F.pow(F.floor(x * scale).cast("double"), F.lit(2.0))),
                         F.lit(0.0), lambda a, x: a + x)
    order = [F.size("_vector"), F.desc("_length"), F.col("_id"), F.col("_copy")]
    return (kept.withColumn("_length", length).repartitionByRange(*order).sortWithinPartitions(*order)
            .select("_id", "_mark", "_vector"))


_FOUND = ("dim int, longest double, seq int, ids binary, marks binary, kind string, vectors binary, floors binary, "
          "need double, block bigint, query_id bigint, mark bigint, vec_id bigint, score bigint")


def _meet(asked: DataFrame, chunks: DataFrame, salts: int, k: int) -> DataFrame:
    """Query blocks, each with the chunk it is sent to, against the chunks' buckets: rows of hits
    (``kind`` null), and one row for each block with its queries' thresholds after this."""
    names = ["chunk", "_salt", "_type", "dim", "longest", "seq", "ids", "marks", "kind", "vectors", "floors", "block"]
    null = {"floors": "binary", "block": "bigint"}
    left = (chunks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("_type", F.lit(0))
            .withColumns({c: F.lit(None).cast(t) for c, t in null.items()}).select(*names))
    right = (asked.withColumn("_salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
             .withColumn("_type", F.lit(1)).select(*names))
    # only the copies of a chunk that some block asks for travel
    left = left.join(right.select("chunk", "_salt").distinct(), ["chunk", "_salt"], "left_semi").select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, buckets = None, []
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if (row["chunk"], row["_salt"]) != at:
                    at, buckets = (row["chunk"], row["_salt"]), []
                own = _unpack(row["ids"], row["marks"], row["kind"], row["vectors"], row["dim"])
                if row["_type"] == 0:
                    norms = _norms(own[2])
                    order = np.lexsort((own[0], -norms))
                    v = own[2][order]
                    unit = v / np.where(norms[order] > 0, norms[order], 1)[:, None]
                    buckets.append((own[0][order], own[1][order], v, norms[order], unit))
                    continue
                best = Best(len(own[0]), k)
                size = len(own[0])
                if row["floors"] is None:
                    floor, floor_ids = np.full(size, -np.inf), np.full(size, _TOP)
                else:
                    floor = np.frombuffer(row["floors"], np.float64, size)
                    floor_ids = np.frombuffer(row["floors"], np.int64, size, 8 * size)
                search(buckets, own, best, floor)
                after = np.maximum(best.threshold(), floor)
                norms = _norms(own[2])
                need = float(np.where(norms > 0, after / np.where(norms > 0, norms, 1),
                                      np.where(after > 0, np.inf, -np.inf)).min())
                need = need * (1 - 1e-9) - 1e-6 if np.isfinite(need) else need
                # what only ties with the k-th of the first pass and has a greater id cannot be among the best
                which, place = np.nonzero((np.arange(k) < best.filled[:, None]) & (
                    (best.scores > floor[:, None]) | (best.ids < floor_ids[:, None])))
                m = len(which)
                head = {"dim": [row["dim"]], "longest": [row["longest"]], "seq": [row["seq"]], "ids": [row["ids"]],
                        "marks": [row["marks"]], "kind": [row["kind"]], "vectors": [row["vectors"]],
                        "floors": [after.tobytes() + best.ids[:, -1].tobytes()], "need": [need], "block": [row["block"]],
                        "query_id": [None], "mark": [None], "vec_id": [None], "score": [None]}
                yield pa.RecordBatch.from_pydict(head, schema=_ARROW)
                if m:
                    none = {c: pa.nulls(m, _ARROW.field(c).type) for c in _ARROW.names}
                    none |= {"block": pa.array([row["block"]] * m, pa.int64()), "query_id": pa.array(own[0][which]),
                             "mark": pa.array(own[1][which]), "vec_id": pa.array(best.ids[which, place]),
                             "score": pa.array(best.scores[which, place])}
                    yield pa.RecordBatch.from_arrays([none[c] for c in _ARROW.names], schema=_ARROW)

    return (left.unionByName(right).repartition("chunk", "_salt")
            .sortWithinPartitions("chunk", "_salt", "_type", "seq").mapInArrow(run, _FOUND))


_TYPES = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string(), "bigint": pa.int64()}
_ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _FOUND.split(", ")])
