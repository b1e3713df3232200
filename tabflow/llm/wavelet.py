"""Token ids in wavelet-matrix files, one per shard.

A shard is a run of documents in ascending id order with about ``SHARD_TOKENS`` ids. Its file holds
one bit-plane per bit of an id, highest first: each plane keeps that bit of every id in the order
that stable partitions by the higher bits leave, plus the number of ones before each block of 512
bits. With ranks and selects on the planes the file gives the id at a place, the number of
occurrences of an id in a range and the places of its occurrences, without decoding the rest.
Planes are compressed one by one.

The files travel as rows of a table (order, blob), one row a shard, so Spark's own commit protocol
writes them to whatever store the path names; a lost task writes its shards anew.

Defined results: a null text is empty; every document ends with the end id, so a document without
text has one id; null document ids come first and are kept as null; repeated rows are separate
documents; an empty table gives no shard and an empty result; ids beyond 16 bits get more planes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.llm.pretokens import BATCH_CHARS, column_batches
from tabflow.llm.tokenizers import text_coder

SHARD_TOKENS = 1 << 20
BLOCK = 512
_MAGIC = b"WVM1"
_BLOB_SCHEMA = "part int, seq int, n_tokens bigint, blob binary"


def _ones_before(packed: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane (and before its end)."""
    blocks = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
    blocks[:len(packed)] = packed
    ones = np.bitwise_count(blocks.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)


def build(ids: np.ndarray, doc_ids: list, counts: np.ndarray) -> bytes:
    """The file of a shard: header, document ids and lengths, then the planes."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    null = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], np.int64)
    parts = [squeeze(null.tobytes()), squeeze(known.tobytes()), squeeze(np.asarray(counts, np.int64).tobytes())]
    row = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    for level in range(levels - 1, -1, -1):
        ones = (row & row.dtype.type(1 << level)) != 0
        packed = np.packbits(ones)
        parts += [squeeze(packed.tobytes()), squeeze(_ones_before(packed).tobytes())]
        if level:  # by places: a mask as index costs a mispredicted branch an id
            row = np.concatenate([row[np.flatnonzero(~ones)], row[np.flatnonzero(ones)]])
    head = _MAGIC + struct.pack("<BqqI", levels, len(ids), len(doc_ids), len(parts))
    return b"".join([head, struct.pack(f"<{len(parts)}I", *map(len, parts)), *parts])


class WaveletMatrix:
    """A shard's file, opened: planes are unpacked when they are first needed."""

    def __init__(self, blob: bytes):
        if blob[:4] != _MAGIC:
            raise ValueError("not a wavelet-matrix file")
        self.levels, self.size, self.n_docs, n = struct.unpack_from("<BqqI", blob, 4)
        at = 4 + struct.calcsize("<BqqI")
        sizes = struct.unpack_from(f"<{n}I", blob, at)
        at += 4 * n
        self._parts = []
        for s in sizes:
            self._parts.append(memoryview(blob)[at:at + s])
            at += s
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _open(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self._parts[k])

    def documents(self) -> tuple[list, np.ndarray]:
        """(document ids, number of ids of each)."""
        null = np.frombuffer(self._open(0), np.uint8)
        known = np.frombuffer(self._open(1), np.int64).tolist()
        return ([None if z else d for z, d in zip(null, known, strict=True)],
                np.frombuffer(self._open(2), np.int64))

    def plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed bits, ones before each block); level 0 holds the highest bits."""
        if level not in self._planes:
            self._planes[level] = (np.frombuffer(self._open(3 + 2 * level), np.uint8),
                                   np.frombuffer(self._open(4 + 2 * level), np.uint32))
        return self._planes[level]

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits."""
        packed, before = self.plane(level)
        b = i // BLOCK
        tail = np.unpackbits(packed[b * BLOCK // 8:-(-i // 8)])[:i - b * BLOCK]
        return int(before[b]) + int(tail.sum())

    def _ones(self, level: int) -> int:
        return int(self.plane(level)[1][-1])

    def _bit(self, level: int, i: int) -> int:
        return int(self.plane(level)[0][i >> 3] >> (7 - (i & 7))) & 1

    def _select(self, level: int, bit: int, k: int) -> int:
        """The place of the ``k``-th (from 0) bit of a kind."""
        packed, before = self.plane(level)
        counts = before.astype(np.int64) if bit else np.arange(len(before)) * BLOCK - before
        b = int(np.searchsorted(counts, k, "right")) - 1
        block = np.unpackbits(packed[b * BLOCK // 8:(b + 1) * BLOCK // 8])
        return b * BLOCK + int(np.flatnonzero(block == bit)[k - int(counts[b])])

    def access(self, i: int) -> int:
        """The id at a place."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        out = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            out = out << 1 | bit
            i = self.size - self._ones(level) + ones if bit else i - ones
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.levels):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if token >> (self.levels - 1 - level) & 1:
                zeros = self.size - self._ones(level)
                lo, hi = zeros + a, zeros + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id among the places ``lo`` to ``hi`` (exclusive)."""
        if token < 0 or token >> self.levels:
            return 0
        a, b = self._range(token, lo, self.size if hi is None else hi)
        return b - a

    def locate(self, token: int) -> list[int]:
        """The places of an id, ascending: each is followed up through the planes by selects."""
        if token < 0 or token >> self.levels:
            return []
        a, b = self._range(token, 0, self.size)
        out = []
        for i in range(a, b):
            for level in range(self.levels - 1, -1, -1):
                bit = token >> (self.levels - 1 - level) & 1
                i = self._select(level, bit, i - (self.size - self._ones(level)) if bit else i)
            out.append(i)
        return out

    def decode(self) -> np.ndarray:
        """All ids in order: the partitions are undone plane by plane, the last one first."""
        values = np.zeros(self.size, np.uint16 if self.levels <= 16 else np.uint32)
        up = np.empty_like(values)
        for level in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.plane(level)[0], count=self.size).view(bool)
            zeros = self.size - self._ones(level)
            values[zeros:] |= values.dtype.type(1 << (self.levels - 1 - level))
            up[np.flatnonzero(~ones)] = values[:zeros]
            up[np.flatnonzero(ones)] = values[zeros:]
            values, up = up, values
        return values.astype(np.uint32)


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` in ascending id order and write the shards' files to ``path``. Range
    partitions keep the order; a task goes through its documents in a stream and closes a shard
    when it has ``shard_tokens`` ids, so it holds one shard at a time."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_coder(tokenizer_path)
        part, seq = TaskContext.get().partitionId(), 0
        ids, names, counts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, names, counts, held, seq
            blob = build(np.concatenate(ids), names, np.concatenate(counts))
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                                              pa.array([held], pa.int64()), pa.array([blob], pa.binary())],
                                             names=["part", "seq", "n_tokens", "blob"])
            ids, names, counts, held, seq = [], [], [], 0, seq + 1
            return out

        for block in blocks:
            for lo, hi in column_batches(block.column(1), min(BATCH_CHARS, 4 * shard_tokens)):
                got, n = coder(block.column(1).slice(lo, hi - lo).to_pylist())
                # the end id goes behind each document
                ids.append(np.insert(got, np.cumsum(n), end_id))
                counts.append(n + 1)
                names += block.column(0).slice(lo, hi - lo).to_pylist()
                held += len(got) + len(n)
                if held >= shard_tokens:
                    yield close()
        if names:
            yield close()

    text = text_of(text_col)
    ordered = (docs.select(F.col(id_col).cast("bigint").alias("_id"), text.alias("_text"))
               .repartitionByRange("_id", F.xxhash64("_text")).sortWithinPartitions("_id", F.xxhash64("_text")))
    ordered.mapInArrow(run, _BLOB_SCHEMA).write.mode("overwrite").parquet(path)


def read_documents(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32, shard_part, shard_seq) from the shards' files."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for part, seq, blob in zip(*(block.column(i) for i in range(3)), strict=True):
                matrix = WaveletMatrix(blob.as_py())
                names, counts = matrix.documents()
                raw = matrix.decode().astype("<u4")
                stops = np.cumsum(counts)
                spans = zip((stops - counts).tolist(), stops.tolist(), strict=True)
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(stops - counts, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                     pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32())],
                    names=[id_col, "_at", "n_tokens", "ids_crc32", "part", "seq"])

    files = spark.read.schema(_BLOB_SCHEMA).parquet(path)
    rows = files.select("part", "seq", "blob").mapInArrow(
        run, f"`{id_col}` bigint, _at bigint, n_tokens bigint, ids_crc32 bigint, part int, seq int")
    # offsets: of a task's shards inside the task, and of the tasks (one row each) among themselves
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    tasks = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.select("part", "seq", F.col("n_tokens").alias("_n"))
    of_task = (shards.groupBy("part").agg(F.sum("_n").alias("_n"))
               .select("part", F.coalesce(F.sum("_n").over(tasks), F.lit(0)).alias("_task")))
    first = (shards.withColumn("_shard", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .join(of_task, "part").select("part", "seq", (F.col("_task") + F.col("_shard")).alias("_first")))
    return (rows.join(first, ["part", "seq"])
            .select(id_col, (F.col("_first") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32",
                    F.col("part").alias("shard_part"), F.col("seq").alias("shard_seq")))
