"""Document fingerprints: quartile bucket digests.

A window of five bytes slides over the text; six triplets of each window are hashed into 256
buckets. A digest holds, for each bucket, the quartile of all buckets that its count falls in (two
bits), and the logarithm of the length. The difference of two digests sums the differences of
quartiles (opposite ends of the scale weigh double) and of lengths; it is bounded by what unrelated
digests differ by, and likeness is 1 minus its share of that bound.

Defined results: a null text is empty; texts under three bytes have no triplet, so their buckets
are all 0 and only lengths differ; the document after the last is the first, a single document is
its own next; repeated rows are separate documents, ordered by id (descending, nulls last), then by
the text's hash; an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.sources.io import materialize

BUCKETS = 256
#: Places in the window of the triplets' bytes; each triplet includes the window's last byte.
TRIPLETS = ((4, 3, 2), (4, 3, 1), (4, 2, 1), (4, 2, 0), (4, 3, 0), (4, 1, 0))
#: Difference of two buckets by the distance of their quartiles.
_APART = np.array([0, 1, 2, 6])
#: Independent quartiles differ by 1.625 a bucket on average: the bound of the difference.
BOUND = 1.625 * BUCKETS
_LENGTH_STEP = math.log(1.1)
_LENGTH_WEIGHT = 4
_PART = 1 << 20


def _byte_tables() -> np.ndarray:
    """Three random tables a triplet; their exclusive or hashes its bytes (tabulation hashing)."""
    return np.random.Generator(np.random.PCG64(5)).integers(0, BUCKETS, (len(TRIPLETS), 3, 256), np.uint8)


_TABLES = _byte_tables()


def digest(raw: bytes) -> np.ndarray:
    """Quartiles of the buckets (0 to 3), then the length's logarithm."""
    b = np.frombuffer(raw, np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(len(b) - 2, 0), _PART):  # long texts by parts that overlap by a window
        part = b[max(0, lo - 2):lo + _PART + 2]
        done = lo - max(0, lo - 2)
        for (i, j, k), (x, y, z) in zip(TRIPLETS, _TABLES, strict=True):
            reach = 4 - min(i, j, k)  # bytes before the last
            n = len(part) - reach
            skip = max(0, 2 + done - reach)
            if n <= skip:
                continue
            at = slice(skip, n)
            h = x[part[reach:]][at] ^ y[part[reach - (4 - j):][:n]][at] ^ z[part[:n]][at]
            counts += np.bincount(h, minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    size = min(255, int(math.log(len(b) + 1) / _LENGTH_STEP))
    return np.append(codes, size).astype(np.uint8)


def to_text(d: np.ndarray) -> str:
    """Hexadecimal: the length, then four buckets a byte."""
    q = d[:BUCKETS].reshape(-1, 4)
    return f"{d[BUCKETS]:02x}" + (q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6).astype(np.uint8).tobytes().hex()


def from_text(s: str) -> np.ndarray:
    b = np.frombuffer(bytes.fromhex(s), np.uint8)
    return np.append(((b[1:, None] >> np.array([0, 2, 4, 6])) & 3).ravel(), b[0]).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 for those that differ as unrelated ones do, or more."""
    apart = np.abs(a.astype(np.int64) - b)
    score = int(_APART[apart[:BUCKETS]].sum()) + _LENGTH_WEIGHT * int(apart[BUCKETS])
    return 1.0 - min(score, BOUND) / BOUND


def edit(text: str, after: str) -> str:
    """The text with the last third of its code points replaced by as many (or all) of another's."""
    n = len(text) // 3
    return text[:len(text) - n] + after[:n]


def _result(doc_id, text: str, own: np.ndarray, after: str, next_digest: np.ndarray) -> tuple:
    changed = edit(text, after).encode()
    other = digest(changed)
    return (doc_id, len(text), hashlib.sha256(changed).hexdigest(), to_text(own), to_text(other),
            likeness(own, other), likeness(own, next_digest))


_FIELDS = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_DDL = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
       "near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Texts are shuffled once, into range partitions of the id; a task goes through its documents in
    order and holds two of them. What joins one partition to the next, its first and last document,
    is written beside the results and joined afterwards."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {id_type}, {_DDL}, _part int, _first string, _last string"

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, None
        id_arrow = None

        def batch(rows: list, ends: list) -> pa.RecordBatch:
            n = len(rows) + len(ends)
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
            arrays = [pa.array([*cols[0], *(e[0] for e in ends)], id_arrow)]
            arrays += [pa.array([*c, *[None] * len(ends)], t) for c, (_, t) in zip(cols[1:], _FIELDS, strict=True)]
            arrays.append(pa.array([part] * n, pa.int32()))
            arrays += [pa.array([None] * len(rows) + [e[k] for e in ends], pa.string()) for k in (1, 2)]
            return pa.RecordBatch.from_arrays(arrays, names=["_id", *(k for k, _ in _FIELDS), "_part", "_first", "_last"])

        for block in blocks:
            id_arrow, rows = block.column(0).type, []
            for doc_id, text in zip(block.column(0), block.column(1), strict=True):
                text = text.as_py()
                own = digest(text.encode())
                if held is None:
                    first = text
                else:
                    rows.append(_result(*held, text, own))
                held = (doc_id.as_py(), text, own)
            yield batch(rows, [])
        if held is not None:
            yield batch([], [(held[0], first, held[1])])

    ordered = (docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
               .withColumn("_h", F.xxhash64("_text")))
    order = [F.col("_id").desc_nulls_last(), F.col("_h")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")
    found = materialize(ordered.mapInArrow(run, schema), "fingerprints")

    # one row a partition: its last document is followed by the first of the next partition
    ends = found.filter(F.col("_last").isNotNull()).select("_id", "_part", "_first", "_last")
    by_part = Window.orderBy("_part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seams = ends.select("_id", "_last", F.coalesce(F.lead("_first").over(by_part),
                                                   F.first("_first").over(whole)).alias("_next"))

    def join_ends(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            rows = []
            for doc_id, text, after in zip(*(block.column(i).to_pylist() for i in range(3)), strict=True):
                rows.append(_result(doc_id, text, digest(text.encode()), after, digest(after.encode())))
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], block.column(0).type),
                 *(pa.array(c, t) for c, (_, t) in zip(cols[1:], _FIELDS, strict=True))],
                names=["_id", *(k for k, _ in _FIELDS)])

    names = [k for k, _ in _FIELDS]
    return (found.filter(F.col("_last").isNull()).select("_id", *names)
            .unionByName(seams.mapInArrow(join_ends, f"_id {id_type}, {_DDL}"))
            .select(F.col("_id").alias(id_col), *names))
