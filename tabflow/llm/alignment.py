"""Tokens of two vocabularies over one text, aligned by the byte offsets at which both end a token.

Both token sequences of a blank and the text are lists of ascending byte ends. ``diagonal_groups``
compares them at the current shift between their indexes: blocks of 1, 2, 4, ... ends as long as all
are equal, then halves of the block that differs, so a stretch of one-to-one tokens is jumped over in
a few comparisons of memory. At the first difference a walk by the smaller end resolves one irregular
group up to the next common end, emits a link for each pair of tokens that overlap, and gives the new
shift.

How often each pair of ids is linked in the whole table is counted in two levels: tasks align blocks
of about ``BLOCK_BYTES`` of text and add links up by pair, a shuffle adds blocks up. Totals go back
to a block once a pair, not once a link, and a block's documents look theirs up; a pair that occurs
everywhere is one row a block. Nothing is broadcast and nothing grows on the driver.

Defined results: a text that is null, empty, or whose tokens do not give back the blank and the text
byte by byte in both vocabularies has no tokens: zeros and an empty digest; an empty table gives an
empty result; repeated rows each get their result and each count; texts of any length are taken whole;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.llm.pretokens import PieceCoder, column_batches, split_words, spread
from tabflow.llm.tokenizers import piece_encoder
from tabflow.llm.transducer import vocabulary
from tabflow.sources.io import materialize

#: Bytes of text whose links are added up in one block (one text at least).
BLOCK_BYTES = 1 << 22


# Aligning ------------------------------------------------------------------------------------------

def diagonal_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[list, list, list, list]:
    """Of two arrays of ascending ends with the same last one: one-to-one stretches (first token of A,
    of B, their number), irregular groups (first token of A, one past the last, the same of B), and the
    links of the irregular groups (tokens of A, tokens of B). Stretches and irregular groups take turns,
    a stretch first (it may be empty); the last stretch may have no group after it."""
    x, y = (np.ascontiguousarray(e, np.int64).tobytes() for e in (a_ends, b_ends))
    a, b = a_ends.tolist(), b_ends.tolist()
    stretches, irregular, link_a, link_b = [], [], [], []
    i = j = 0
    n, m = len(a), len(b)
    while i < n:
        first, shift = i, j - i
        if a[i] == b[j]:
            size, most = 1, min(n, m - shift)  # tokens that the current shift can compare
            while i + size <= most and x[8 * i:8 * (i + size)] == y[8 * (i + shift):8 * (i + shift + size)]:
                i += size
                size *= 2
            while size > 1:
                size //= 2
                if i + size <= most and x[8 * i:8 * (i + size)] == y[8 * (i + shift):8 * (i + shift + size)]:
                    i += size
        stretches.append((first, j, i - first))
        if i == n:
            break
        first, j = i, i + shift
        begin, p, q = j, a[i], b[j]
        while True:
            link_a.append(i)
            link_b.append(j)
            if p < q:
                i += 1
                p = a[i]
            elif p > q:
                j += 1
                q = b[j]
            else:
                break
        i, j = i + 1, j + 1
        irregular.append((first, i, begin, j))
    return stretches, irregular, link_a, link_b


class ByteSide:
    """Tokens of a byte-level vocabulary; its special strings are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        # the vocabulary splits before it merges, so a batch's distinct pieces are encoded once
        self.encode = PieceCoder(piece_encoder(tokenizer))
        self._table(vocabulary(path).bytes)

    def _table(self, tokens: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """(ids of a blank and each text, in a row; number of ids of each; bytes of each id; all their bytes)."""
        ids, counts = self.encode([" " + t for t in texts])
        sizes = self.sizes[ids]
        return ids, counts, sizes, self.bytes[spread(self.offsets[ids], sizes)].tobytes()


class PieceSide(ByteSide):
    """Tokens of a sentencepiece model, which puts the blank before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        self._table([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                     for i in range(self.model.get_piece_size()) for p in [self.model.id_to_piece(i)]])
        if word_by_word(self.model):
            # a batch's distinct words are encoded once; the model puts a word's first blank before it itself
            self.encode = PieceCoder(lambda words: self._whole([w[1:] for w in words]), split=split_words)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        ids, counts = self.encode([" " + t for t in texts]) if hasattr(self, "encode") else self._whole(texts)
        sizes = self.sizes[ids]
        return ids, counts, sizes, self.bytes[spread(self.offsets[ids], sizes)].tobytes()


def word_by_word(model) -> bool:
    """Whether a sentencepiece model merges within words only: it merges pairs, takes texts as they are
    with one blank put before them, and no token holds a blank behind another character. Then merges
    in a word, with the blanks before it, know nothing of other words."""
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    norm, n = proto.normalizer_spec, model.get_piece_size()
    return (proto.trainer_spec.model_type == proto.trainer_spec.BPE and not norm.precompiled_charsmap
            and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix and not proto.trainer_spec.user_defined_symbols
            and sum(map(model.is_byte, range(n))) == 256  # else unknown characters in a row would be one token
            and not any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(n)))


@functools.lru_cache(4)
def side(path: str) -> ByteSide:
    """One per Python worker and file."""
    return PieceSide(path) if path.endswith(".model") else ByteSide(path)


@functools.lru_cache(4)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 to ``n - 1``, a row each, and how many there are."""
    written = np.array([b"%d" % i for i in range(n)])
    return written.view(np.uint8).reshape(len(written), -1), np.char.str_len(written)


class Aligned:
    """The tokens, groups and links of a batch of texts."""

    def __init__(self, texts: list[str], a_side: ByteSide, b_side: ByteSide):
        self.sides = (a_side, b_side)
        held = [a_side.tokens(texts), b_side.tokens(texts)]
        self.ids = [h[0] for h in held]
        stops = [np.append(0, np.cumsum(h[1])) for h in held]
        at = [np.append(0, np.cumsum(h[2])) for h in held]  # where tokens lie in the joined bytes
        n = len(texts)
        self.n_a, self.n_b, self.n_groups = (np.zeros(n, np.int64) for _ in range(3))
        self.spans, self.groups = [(0, 0, 0, 0)] * n, [([], [])] * n
        stretches, odds, links_a, links_b = [], [], [], []
        self.n_tokens = [np.diff(s) for s in stops]
        self.n_links, self.n_odd = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k, text in enumerate(texts):
            spans = [(int(s[k]), int(s[k + 1])) for s in stops]
            bounds = [(int(p[lo]), int(p[hi])) for p, (lo, hi) in zip(at, spans, strict=True)]
            raw = (" " + text).encode()
            if not text or any(h[3][lo:hi] != raw for h, (lo, hi) in zip(held, bounds, strict=True)):
                continue
            (a0, a1), (b0, b1) = spans
            one, odd, met_a, met_b = diagonal_groups(at[0][a0 + 1:a1 + 1] - bounds[0][0], at[1][b0 + 1:b1 + 1] - bounds[1][0])
            self.n_a[k], self.n_b[k] = a1 - a0, b1 - b0
            self.n_groups[k] = sum(s for _, _, s in one) + len(odd)
            self.spans[k], self.groups[k] = (a0, a1, b0, b1), (one, odd)
            stretches.append(np.array(one, np.int64) + (a0, b0, 0))
            odds.append(np.array(odd, np.int64).reshape(-1, 4)[:, ::2] + (a0, b0))
            links_a.append(np.array(met_a, np.int64) + a0)
            links_b.append(np.array(met_b, np.int64) + b0)
            self.n_odd[k] = len(met_a)
            self.n_links[k] = len(met_a) + sum(s for _, _, s in one)
        runs = np.concatenate(stretches) if stretches else np.zeros((0, 3), np.int64)
        single = [spread(runs[:, x], runs[:, 2]) for x in (0, 1)]
        #: The first tokens of all groups, of A and of B.
        self.firsts = [np.concatenate([single[x], *[o[:, x] for o in odds]]).astype(np.int64) for x in (0, 1)]
        # links of all stretches, text by text, then those of irregular groups
        keys = ((self.ids[0][np.concatenate([single[0], *links_a])].astype(np.int64) << 32)
                | self.ids[1][np.concatenate([single[1], *links_b])].astype(np.int64))
        self.pairs, self.place, self.times = np.unique(keys, return_inverse=True, return_counts=True)

    def written(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``, all tokens of the batch at once."""
        ids, first, before = [], [], []
        for x, n in enumerate((self.n_a, self.n_b)):
            mark = np.zeros(len(self.ids[x]), bool)
            mark[self.firsts[x]] = True
            kept = np.repeat(n > 0, self.n_tokens[x])  # texts without groups have no tokens
            ids.append(self.ids[x][kept].astype(np.int64))
            first.append(mark[kept])
            before.append(np.append(0, np.cumsum(n)))
        # a group's tokens of A, then those of B: behind the tokens of both in the groups before it
        begin = [np.append(np.flatnonzero(f), len(f)) for f in first]
        group = [np.cumsum(f) - 1 for f in first]
        place_a = np.arange(len(ids[0])) + begin[1][group[0]]
        place_b = np.arange(len(ids[1])) + begin[0][group[1] + 1]
        token, close = np.zeros(len(ids[0]) + len(ids[1]), np.int64), np.full(len(ids[0]) + len(ids[1]), ord(","), np.uint8)
        token[place_a], token[place_b] = ids
        close[place_a[begin[0][1:] - 1]], close[place_b[begin[1][1:] - 1]] = ord("|"), ord(";")
        digits, sizes = _decimals(max(len(side.sizes) for side in self.sides))
        size = sizes[token]
        at = np.append(0, np.cumsum(size + 1))
        out = np.empty(at[-1], np.uint8)
        for k in range(digits.shape[1]):
            has = np.flatnonzero(size > k)
            out[at[has] + k] = digits[token[has], k]
        out[at[1:] - 1] = close
        stops, joined = at[before[0] + before[1]].tolist(), out.tobytes()
        return [joined[lo:max(lo, hi - 1)].decode() for lo, hi in zip(stops, stops[1:], strict=False)]

    def places(self) -> Iterator[np.ndarray]:
        """The pairs of each text's links, as places in ``pairs``."""
        mid = len(self.place) - int(self.n_odd.sum())
        odd = mid + np.append(0, np.cumsum(self.n_odd))
        one = np.append(0, np.cumsum(self.n_links - self.n_odd))
        for k in range(len(self.n_links)):
            yield np.concatenate([self.place[one[k]:one[k + 1]], self.place[odd[k]:odd[k + 1]]])

    def bounds(self, k: int) -> tuple[list[int], list[int]]:
        """Where the groups of a text end: one past their last token of A and of B."""
        one, odd = self.groups[k]
        ends = [(i + x, j + x) for i, j, s in one for x in range(1, s + 1)] + [(i2, j2) for _, i2, _, j2 in odd]
        ends.sort()
        return [i for i, _ in ends], [j for _, j in ends]


# On Spark ------------------------------------------------------------------------------------------

def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x, "<i4").tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), "<i4")


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, b_ids, a_ends, b_ends): the tokens of each text and, group by group, one past the
    last token of A and of B. ``path_a``, ``path_b``: files that every executor has, a byte-level
    vocabulary (.json) or a sentencepiece model (.model)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_ends", "b_ends"))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for lo, hi in column_batches(block.column(1)):
                found = Aligned(block.column(1).slice(lo, hi - lo).to_pylist(), side(path_a), side(path_b))
                rows = [(found.ids[0][s[0]:s[1]], found.ids[1][s[2]:s[3]], *found.bounds(k)) for k, s in enumerate(found.spans)]
                cols = [pa.array([np.asarray(x, np.int32) for x in col], pa.list_(pa.int32())) for col in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([block.column(0).slice(lo, hi - lo), *cols],
                                                 names=[id_col, "a_ids", "b_ids", "a_ends", "b_ends"])

    return docs.select(F.col(id_col), text_of(text_col).alias("_text")).mapInArrow(run, schema)


def _blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """A row a document: counts, digest of its groups, the pair of each link as its place in the sorted
    pairs of its block; the first row of a block carries the block's pairs."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"_block bigint, `{id_col}` {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups_sha256 string, _places binary, _pairs array<bigint>, _counts array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in column_batches(batch.column(1), BLOCK_BYTES):
                found = Aligned(batch.column(1).slice(lo, hi - lo).to_pylist(), side(path_a), side(path_b))
                n = hi - lo
                digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in found.written()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), batch.column(0).slice(lo, n), pa.array(found.n_a), pa.array(found.n_b),
                     pa.array(found.n_groups), pa.array(found.n_links, pa.int64()), pa.array(digests, pa.string()),
                     pa.array([_pack(p) for p in found.places()], pa.binary()),
                     pa.array([found.pairs] + [None] * (n - 1), pa.list_(pa.int64())),
                     pa.array([found.times] + [None] * (n - 1), pa.list_(pa.int64()))],
                    names=["_block", id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_places",
                           "_pairs", "_counts"])
                number += 1

    return docs.select(F.col(id_col), text_of(text_col).alias("_text")).mapInArrow(run, schema)


def pair_counts(listed: DataFrame) -> DataFrame:
    """(_pair, _total, _top) from rows (_pair, _n): links of each pair, and whether no other pair with
    the same id of B has more. Grouped by the pair first, so a frequent id of B is a row a pair."""
    totals = listed.groupBy("_pair").agg(F.sum("_n").alias("_total"))
    return totals.withColumn("_top", F.col("_total") == F.max("_total").over(
        Window.partitionBy(F.col("_pair").bitwiseAND(F.lit(0xFFFFFFFF)))))


def link_statistics(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): tokens, groups and links
    of each text; links whose pair is linked most often of all pairs with its id of B in the table;
    the sum of all links' counts; digest of the groups."""
    id_type = docs.schema[id_col].dataType.simpleString()
    held = materialize(_blocks(docs, path_a, path_b, id_col, text_col), "aligned")
    listed = (held.filter(F.col("_pairs").isNotNull())
              .select("_block", F.explode(F.arrays_zip(F.col("_pairs").alias("p"), F.col("_counts").alias("c"))).alias("x"))
              .select("_block", F.col("x.p").alias("_pair"), F.col("x.c").alias("_n")))
    totals = materialize(pair_counts(listed), "pair-counts")
    known = listed.select(F.col("_block").alias("_of"), "_pair").join(totals, "_pair")
    out = (f"`{id_col}` {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")

    def look_up(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs["_pair"].to_numpy())
        total, top = pairs["_total"].to_numpy()[order], pairs["_top"].to_numpy()[order]
        best, sums = [], []
        for places in rows["_places"].to_pylist():
            at = _unpack(places)
            best.append(int(top[at].sum()))
            sums.append(int(total[at].sum()))
        return pa.table([rows[id_col], *(rows[c] for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(best, pa.int64()),
                         pa.array(sums, pa.int64()), rows["groups_sha256"]],
                        names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    rows = held.drop("_pairs", "_counts")
    return rows.groupBy("_block").cogroup(known.groupBy("_of")).applyInArrow(look_up, out)
