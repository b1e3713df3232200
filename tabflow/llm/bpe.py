"""Byte-level BPE encoding and decoding on padded numpy matrices.

Distinct pieces of a batch are put into matrices by length, one piece a row. In every round each
row merges its leftmost pair of least rank; pairs are looked up in an open-addressing hash table,
rows are closed up by one place, and finished rows leave the matrix. Pieces over ``LONG_ROW``
bytes, for which rounds over a whole row would be slow, merge by a heap in the same order.

Defined results: a null text is empty and has no ids; an empty table gives an empty result;
repeated rows are encoded one by one; a text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.llm.pretokens import PieceCoder, column_batches, spread

#: Rows up to this many bytes are merged in matrices.
LONG_ROW = 256
_NONE = np.int32(np.iinfo(np.int32).max)
_BUCKETS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64, 128, LONG_ROW)


class PairTable:
    """(left id, right id) to the id of their merge, which is its rank: open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(size, _NONE, np.int32)
        at, todo, self.probes = self._home(keys), np.arange(len(keys)), 0
        while len(todo):
            free = self.keys[at] == np.iinfo(np.uint64).max
            placed, first = np.unique(at[free], return_index=True)
            who = todo[np.flatnonzero(free)[first]]
            self.keys[placed], self.values[placed] = keys[who], merged[who]
            rest = self.keys[at] != keys[todo]
            todo, at, self.probes = todo[rest], (at[rest] + 1) % size, self.probes + 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, ``_NONE`` where a pair doesn't merge (or an id is a pad, below 0)."""
        shape = left.shape
        keys = ((left.astype(np.int64).ravel() << 32) | (right.astype(np.int64).ravel() & 0xFFFFFFFF)).astype(np.uint64)
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], _NONE)
        open_ = np.flatnonzero((held != keys) & (held != np.iinfo(np.uint64).max))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % len(self.keys)
            held = self.keys[at[open_]]
            out[open_] = np.where(held == keys[open_], self.values[at[open_]], out[open_])
            open_ = open_[(held != keys[open_]) & (held != np.iinfo(np.uint64).max)]
        return out.reshape(shape)


class BytePairs:
    """The merges of a file of ranks (a line for each: base64 of its bytes, its rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.pairs = PairTable(*(np.array(x, np.int64) for x in (left, right)), np.array(merged, np.int32))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        most = max(self.ranks.values()) + 1
        self.lengths = np.zeros(most, np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        self.bytes = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)

    def encode(self, pieces: list[str]) -> list:
        """The ids of each piece: of one that is a token itself, that token; else by merging."""
        out: list = [None] * len(pieces)
        by_length: dict[int, list[int]] = {}
        raw = [p.encode() for p in pieces]
        for i, b in enumerate(raw):
            if (whole := self.ranks.get(b)) is not None:
                out[i] = (whole,)
            elif len(b) > LONG_ROW:
                out[i] = self._merge_long(b)
            else:
                by_length.setdefault(next(w for w in _BUCKETS if len(b) <= w), []).append(i)
        for width, rows in by_length.items():
            for lo in range(0, len(rows), 1 << 14):
                part = rows[lo:lo + (1 << 14)]
                for i, ids in zip(part, self._merge_rows([raw[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, rows: list[bytes], width: int) -> list:
        padded = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = self.byte_ids[padded]
        ids[np.arange(width) >= sizes[:, None]] = -1
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        ranks[ids[:, 1:] < 0] = _NONE
        out: list = [None] * len(rows)
        live = np.arange(len(rows))
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            done = best == _NONE
            if done.any():  # finished rows leave
                for i, row in zip(live[done].tolist(), ids[done], strict=True):
                    out[i] = row[row >= 0]
                ids, ranks, live, at, best = ids[~done], ranks[~done], live[~done], at[~done], best[~done]
                if not len(live):
                    break
            w, k = ids.shape[1], np.arange(len(live))
            ids[k, at] = best
            # close the gap: what stands right of the merged pair moves one place to the left
            take = np.arange(w - 1) + (np.arange(w - 1) > at[:, None])
            ids = np.take_along_axis(ids, take, 1)
            if w == 2:
                ranks = np.full((len(live), 1), _NONE, np.int32)
                ids = np.concatenate([ids, np.full((len(live), 1), -1, ids.dtype)], 1)
                continue
            ranks = np.take_along_axis(ranks, take[:, :-1], 1)
            for j in (at - 1, at):  # only the pairs beside the merged one are new
                ok = np.flatnonzero((j >= 0) & (j < w - 2))
                a, b = ids[ok, j[ok]], ids[ok, j[ok] + 1]
                new = self.pairs.find(a, b)
                new[b < 0] = _NONE
                ranks[ok, j[ok]] = new
        return out

    def _merge_long(self, piece: bytes) -> list:
        ids: list = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        none = int(_NONE)
        heap = [(r, i) for i, r in enumerate(first) if r != none]
        heapq.heapify(heap)
        rank_at = first + [none]
        table = _pair_dict(self)
        while heap:
            r, i = heapq.heappop(heap)
            if rank_at[i] != r:
                continue
            j = after[i]
            ids[i], rank_at[j], ids[j] = r, none, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x in (before[i], i):
                if x < 0:
                    continue
                y = after[x]
                rank_at[x] = table.get((ids[x], ids[y]), none) if y < n else none
                if rank_at[x] != none:
                    heapq.heappush(heap, (rank_at[x], x))
        return [x for x in ids if x >= 0]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``counts`` ids."""
        lengths = self.lengths[ids]
        joined = self.bytes[spread(self.offsets[ids], lengths)].tobytes()
        at = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(lengths, out=at[1:])
        stops = np.cumsum(counts)
        return [joined[a:b] for a, b in zip(at[stops - counts].tolist(), at[stops].tolist(), strict=True)]


def _pair_dict(pairs: BytePairs) -> dict:
    if not hasattr(pairs, "_dict"):
        kept = pairs.pairs.keys != np.iinfo(np.uint64).max
        keys, values = pairs.pairs.keys[kept].tolist(), pairs.pairs.values[kept].tolist()
        pairs._dict = {(k >> 32, k & 0xFFFFFFFF): v for k, v in zip(keys, values, strict=True)}
    return pairs._dict


@functools.lru_cache(2)
def coder(path: str) -> tuple[BytePairs, PieceCoder]:
    """One per Python worker and file."""
    pairs = BytePairs(path)
    return pairs, PieceCoder(pairs.encode)


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]): ids of each whole text by the ranks in
    ``ranks_path`` (a file that every executor has), digests of the ids as little-endian unsigned
    32-bit integers and of the bytes they decode to. Documents are independent: no shuffle, and a
    lost task only repeats its own rows."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, pieces = coder(ranks_path)
        for block in blocks:
            for lo, hi in column_batches(block.column(1)):
                texts = block.column(1).slice(lo, hi - lo).to_pylist()
                ids, counts = pieces(texts)
                stops = np.cumsum(counts)
                spans = list(zip((stops - counts).tolist(), stops.tolist(), strict=True))
                wide = ids.astype("<u4")
                cols = [block.column(0).slice(lo, hi - lo), pa.array(counts, pa.int64()),
                        pa.array([hashlib.sha256(wide[a:b]).hexdigest() for a, b in spans], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in pairs.decode(ids, counts)], pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    offsets = pa.array(np.concatenate([[0], stops]), pa.int32())
                    cols.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(id_col), text_of(text_col).alias("_text")).mapInArrow(run, schema)
