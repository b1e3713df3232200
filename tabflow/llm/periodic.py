"""Periodic runs of words, found through a dictionary of basic factors.

A text is its words ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of at least ``max(6, 4 q)`` words with
smallest period ``q`` (words ``q`` apart are equal) that no neighbouring word extends. The dictionary
gives equal factors of length 1, 2, 4, ... equal names, each level from pairs of names of the one
below; only factors that occur again in their text go on, so of ordinary prose little is left after
a few levels. On the level of length ``l`` a factor and its next occurrence, when both lie within a
window of ``2 l`` words, are at most ``l`` apart; factors at consecutive words with the same distance
``d`` form arithmetic progressions and propose the period ``d``. Proposals are extended word by word
to both sides and deduplicated.

Nothing is missed: a run of period ``q`` and ``4 q`` words or more has, on the level ``q <= l < 2 q``,
at least ``q`` consecutive factors whose next occurrence is exactly ``q`` words on (a nearer one would
make its root a power of a shorter word). For the same reason no proposal that reaches the least
length has a smaller period.

Documents are independent: there is no shuffle, and a lost task repeats only its own rows. All texts
of a batch go through the levels together, one level in memory at a time. Defined results: a null,
empty or blank text has no words and no runs; an empty table gives an empty result; repeated rows
each get theirs; texts of any length are taken whole; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.llm.pretokens import column_batches

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_WORDS, MIN_PERIODS = 6, 4


def word_codes(docs: list[list[str]]) -> np.ndarray:
    """Numbers of all words in a row; words of different texts never get the same number."""
    out, base = [], 0
    for words in docs:
        known: dict[str, int] = {}
        out.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + base)
        base += len(known)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _successors(key: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, positions, distances to the next occurrence, 0 for the last one) of the factors that
    occur more than once, by position. ``pos`` ascends; equal keys are equal factors."""
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[1:] |= same
    again[:-1] |= same
    names = np.cumsum(np.append(True, ~same)) - 1 if len(key) else np.zeros(0, np.int64)
    distance = np.zeros(len(key), np.int64)
    distance[:-1][same] = (pos[order[1:]] - pos[order[:-1]])[same]
    name_at, distance_at, kept = (np.empty_like(x) for x in (names, distance, again))
    name_at[order], distance_at[order], kept[order] = names, distance, again
    return name_at[kept], pos[kept], distance_at[kept]


def runs_of(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start within it, length, period) of every run, ordered by text, start and period, of
    texts whose words lie in a row in ``codes``."""
    ends = np.cumsum(sizes)
    n = len(codes)
    text_end = np.repeat(ends, sizes)
    found: set[tuple[int, int, int]] = set()
    length, most = 1, int(sizes.max(initial=0))
    name, pos, distance = _successors(codes, np.arange(n))
    while len(pos):
        _propose(codes, ends, text_end, pos, distance, length, found)
        if 2 * length * 2 > most:  # the next level serves periods above its half, which need four times their length
            break
        full = np.full(n, -1, np.int64)
        full[pos] = name
        ok = pos + 2 * length <= text_end[pos]
        left, pos = name[ok], pos[ok]
        right = full[pos + length]
        ok = right >= 0
        name, pos, distance = _successors(left[ok] * n + right[ok], pos[ok])
        length *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    every = np.array(sorted((a, q, b) for a, b, q in found), np.int64)
    start, period, stop = every.T
    text = np.searchsorted(ends, start, "right")
    return text, start - (ends - sizes)[text], stop - start, period


def _propose(codes, ends, text_end, pos, distance, length, found) -> None:
    """Add the runs that the successors of one level propose to ``found`` as (start, stop, period)."""
    near = (distance > 0) & (distance <= length)
    at, d = pos[near], distance[near]
    if not len(at):
        return
    # stretches of consecutive words whose factors come again at one distance
    cut = np.append(True, (at[1:] != at[:-1] + 1) | (d[1:] != d[:-1]) | (text_end[at[1:]] != text_end[at[:-1]]))
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(at)) - 1
    # at the level just above its period a run's stretch has the period's length at least
    long = last - first + 1 >= d[first]
    for a, b, q in zip(at[first[long]].tolist(), at[last[long]].tolist(), d[first[long]].tolist(), strict=True):
        text = int(np.searchsorted(ends, a, "right"))
        begin = int(ends[text - 1]) if text else 0
        start = a - _agreeing(codes[begin:a][::-1], codes[begin + q:a + q][::-1])
        b += q + length
        stop = b + _agreeing(codes[b:ends[text]], codes[b - q:ends[text] - q])
        if stop - start >= max(MIN_WORDS, MIN_PERIODS * q):
            found.add((start, stop, q))


def _agreeing(x: np.ndarray, y: np.ndarray) -> int:
    """How many words two views have in common from their beginning, looked up in doubling steps."""
    done, step = 0, 8
    while done < len(x):
        differ = np.flatnonzero(x[done:done + step] != y[done:done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, 2 * step
    return len(x)


def dropped(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:n]) > 0


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              edit: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed): every run as (start, length, period), by start and period, and
    the text whose runs are cut down to their first period, words joined by single blanks. ``edit``
    may replace the words of a document, given its id and words, before they are looked at."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, n_words bigint, "
              "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for lo, hi in column_batches(block.column(1)):
                ids, column = block.column(0).slice(lo, hi - lo), block.column(1).slice(lo, hi - lo)
                words = [_WORD.findall(t) for t in column.to_pylist()]
                if edit is not None:
                    words = [edit(i, w) for i, w in zip(ids.to_pylist(), words, strict=True)]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                text, start, length, period = runs_of(word_codes(words), sizes)
                stops = np.searchsorted(text, np.arange(len(words) + 1))
                collapsed = []
                for k, (a, b) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)):
                    if a < b:
                        gone = dropped(len(words[k]), start[a:b], length[a:b], period[a:b])
                        words[k] = [w for w, g in zip(words[k], gone.tolist(), strict=True) if not g]
                    collapsed.append(" ".join(words[k]))
                runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)],
                                                  names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes), pa.ListArray.from_arrays(pa.array(stops, pa.int32()), runs),
                     pa.array(collapsed, pa.string())], names=[id_col, "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col), text_of(text_col).alias("_text")).mapInArrow(run, schema)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the longest
    run (of equally long ones the first, then the one of the smaller period), digests of all runs and
    of the collapsed text."""
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"),
                                                    r["period"].alias("period")))
    best = F.when(F.size("runs") > 0, F.array_min(ranked))
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return (found.withColumn("_best", best)
            .select(id_col, F.size("runs").cast("bigint").alias("n_runs"), F.col("_best.start").alias("start"),
                    (-F.col("_best.short")).alias("length"), F.col("_best.period").alias("period"),
                    F.expr("(-1000 * _best.short) div _best.period").alias("exponent_milli"),
                    F.sha2(F.concat_ws("", listed), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
