"""Byte-level BPE through a minimal acyclic transducer of frequent words, exact for all others.

The words (pieces of the vocabulary's pre-tokenizer) of the whole table are counted; the most
frequent ones, at most ``LEXICON_WORDS``, are merged once and compiled into a minimal acyclic
transducer: words with equal endings share states, and a word's ids are written along its path, each
as early as the words that share the path agree on it. The automaton is one file of flat arrays in
the shared store, sent to executors as a Spark file and memory-mapped by their workers, so all
workers of a machine read the same pages. A batch walks all its words through it at once, a byte a
step; words that it doesn't hold are merged exactly by rank. The lexicon only saves work: ids never
depend on which words it holds.

Defined results: a null text is empty and has no ids; an empty table gives an empty result and an
empty lexicon; repeated rows are encoded one by one; texts and words of any length are encoded
whole; columns other than the id and the text are not read. The vocabulary's special strings inside
a text become their ids, as the library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import text_of
from tabflow.llm.pretokens import batches, column_batches, spread, split
from tabflow.sources.io import materialize, run_path

#: Words of the lexicon at most, and bytes of a word at most: the automaton's size is bounded.
LEXICON_WORDS = 1 << 16
WORD_BYTES = 48
#: Words that a counting task holds before it passes its counts on.
HELD_WORDS = 1 << 17
#: Merged words that a worker remembers before it forgets them all.
CACHED_WORDS = 1 << 17


# The transducer --------------------------------------------------------------------------------

class _State:
    __slots__ = ("arcs", "final", "tail")

    def __init__(self):
        self.arcs: dict[int, list] = {}  # byte -> [state, or number once shared; ids on the arc]
        self.final, self.tail = False, ()  # tail: ids that follow when a word ends here


def compile_words(words: list[tuple[bytes, tuple]]) -> bytes:
    """The minimal transducer of distinct words with their ids, as the bytes of a file."""
    shared: dict = {}
    states: list[_State] = []

    def settle(state: _State) -> int:
        """The number of the state that equals this one in endings and ids, itself if it is the first."""
        key = (state.final, state.tail, tuple((b, t, out) for b, (t, out) in sorted(state.arcs.items())))
        if key not in shared:
            shared[key] = len(states)
            states.append(state)
        return shared[key]

    def close(path: list[_State], word: bytes, keep: int) -> None:
        for i in range(len(word), keep, -1):
            path[i - 1].arcs[word[i - 1]][0] = settle(path[i])
        del path[keep + 1:]

    path, before = [_State()], b""
    for word, ids in sorted(words):
        same = next((i for i, (a, b) in enumerate(zip(word, before)) if a != b), min(len(word), len(before)))
        close(path, before, same)
        for i in range(same):  # ids that the words on this path don't share move on
            arc = path[i].arcs[word[i]]
            k = next((j for j, (a, b) in enumerate(zip(arc[1], ids)) if a != b), min(len(arc[1]), len(ids)))
            rest, arc[1], ids = arc[1][k:], arc[1][:k], ids[k:]
            if rest:
                for nxt in path[i + 1].arcs.values():
                    nxt[1] = rest + nxt[1]
                if path[i + 1].final:
                    path[i + 1].tail = rest + path[i + 1].tail
        for i in range(same, len(word)):
            path.append(_State())
            path[i].arcs[word[i]] = [path[i + 1], ids if i == same else ()]
        path[-1].final, path[-1].tail = True, ids if same == len(word) else ()
        before = word
    close(path, before, 0)
    root = settle(path[0])
    return _pack(states, root, max((len(w) for w, _ in words), default=0))


def _pack(states: list[_State], root: int, depth: int) -> bytes:
    """Flat arrays: each state has a bitmap of its bytes, and its arcs lie in the order of their bytes."""
    pool: list[int] = []
    at: dict[tuple, int] = {(): 0}

    def place(ids: tuple) -> int:
        if ids not in at:
            at[ids] = len(pool)
            pool.extend(ids)
        return at[ids]

    bits = np.zeros((len(states), 4), np.uint64)
    rank = np.zeros((len(states), 4), np.int32)
    tails, arcs = [], []
    for s, state in enumerate(states):
        tails.append((state.final, place(state.tail), len(state.tail)))
        for b, (target, out) in sorted(state.arcs.items()):
            bits[s, b >> 6] |= np.uint64(1 << (b & 63))
            rank[s, (b >> 6) + 1:] += 1
            arcs.append((target, place(out), len(out)))
        rank[s] += len(arcs) - len(state.arcs)
    arrays = {"bits": bits, "rank": rank, "arcs": np.array(arcs, np.int32).reshape(-1, 3),
              "tails": np.array(tails, np.int32).reshape(-1, 3), "pool": np.array(pool, np.int32)}
    body, parts, lengths = 0, [], {}
    for name, x in arrays.items():
        raw = x.tobytes()
        lengths[name] = [str(x.dtype), list(x.shape), body, len(raw)]
        parts.append(raw + bytes(-len(raw) % 64))
        body += len(parts[-1])
    head = json.dumps({"arrays": lengths, "root": root, "depth": depth}).encode()
    head = head + b" " * (-(len(head) + 8) % 64)
    return len(head).to_bytes(8, "little") + head + b"".join(parts)


class Lexicon:
    """A compiled lexicon, read from its memory-mapped file."""

    def __init__(self, path: str):
        held = np.memmap(path, np.uint8, "r").view(np.ndarray)
        size = int.from_bytes(held[:8].tobytes(), "little")
        head = json.loads(held[8:8 + size].tobytes())
        self.root, self.depth = head["root"], head["depth"]
        for name, (kind, shape, at, n) in head["arrays"].items():
            setattr(self, name, held[8 + size + at:8 + size + at + n].view(kind).reshape(shape))

    def walk(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words that lie in ``data``: (which ones the lexicon holds, number of ids of each, all
        their ids in a row)."""
        held = np.zeros(len(starts), bool)
        counts = np.zeros(len(starts), np.int64)
        who = np.flatnonzero((sizes > 0) & (sizes <= self.depth))
        state = np.full(len(who), self.root, np.int64)
        written: list = []  # (words, place of the ids in the pool, their number), step by step
        step = 0
        while len(who):
            byte = data[starts[who] + step]
            quarter, bit = byte >> 6, (byte & 63).astype(np.uint64)
            bits = self.bits[state, quarter]
            ok = (bits >> bit) & np.uint64(1) != 0
            below = np.bitwise_count(bits & ((np.uint64(1) << bit) - np.uint64(1)))
            arc = self.arcs[(self.rank[state, quarter] + below)[ok]]
            who, state, step = who[ok], arc[:, 0].astype(np.int64), step + 1
            out = arc[:, 2] > 0
            written.append((who[out], arc[out, 1], arc[out, 2]))
            end = sizes[who] == step
            if end.any():
                tail = self.tails[state[end]]
                there = tail[:, 0] != 0
                done, tail = who[end][there], tail[there]
                held[done] = True
                out = tail[:, 2] > 0
                written.append((done[out], tail[out, 1], tail[out, 2]))
                who, state = who[~end], state[~end]
        if not written:
            return held, counts, np.zeros(0, np.int32)
        word, place, n = (np.concatenate(x) for x in zip(*written, strict=True))
        kept = held[word]
        word, place, n = word[kept], place[kept].astype(np.int64), n[kept].astype(np.int64)
        order = np.argsort(word, kind="stable")
        np.add.at(counts, word, n)
        return held, counts, self.pool[spread(place[order], n[order])]


# The vocabulary ----------------------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: bytes with a visible Latin-1
    character are that character, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteVocabulary:
    """A byte-level BPE vocabulary as the tokenizers library stores it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"]
                or not before.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        letters, vocab = _byte_letters(), model["vocab"]
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.ranks, self.made = {}, []  # which pairs merge, by rank, and into what
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if len(self.special) > 1 or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"special strings with rules of their own: {path}")
        most = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list = [b""] * most
        for token, i in [*vocab.items(), *self.special.items()]:
            known = all(c in letters for c in token)
            self.bytes[i] = bytes(letters[c] for c in token) if known else token.encode()

    def merge(self, word: bytes) -> tuple:
        """The ids of one word: the pair of least rank, the leftmost of equal ones, merges until none does."""
        if len(word) > 40:
            return self._merge_long(word)
        ids, rank_of, none = [self.byte_ids[b] for b in word], self.ranks.get, len(self.made)
        ranks = [rank_of(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == none:
                break
            i = ranks.index(rank)
            ids[i] = self.made[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), none)
        return tuple(ids)

    def _merge_long(self, word: bytes) -> tuple:
        """The same with a heap over linked places, for words of any length."""
        ids, n, ranks = [self.byte_ids[b] for b in word], len(word), self.ranks
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i] if ids[i] >= 0 else n
            if j >= n or ranks.get((ids[i], ids[j])) != rank:
                continue  # one of the two has merged since
            ids[i], ids[j], k = self.made[rank], -1, right[j]
            right[i] = k
            if k < n:
                left[k] = i
            for a, b in ((left[i], i), (i, k)):
                if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                    heapq.heappush(heap, (ranks[ids[a], ids[b]], a))
        return tuple(x for x in ids if x >= 0)


@functools.lru_cache(2)
def vocabulary(path: str) -> ByteVocabulary:
    """One per Python worker and file."""
    return ByteVocabulary(path)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts in a row, where words start, their bytes, number of words of each text)."""
    code, starts, counts = split(texts)
    width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    at = np.zeros(len(code) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    first = at[starts]
    return data, first, np.append(first[1:], at[-1:])[:len(first)] - first, counts


class LexiconCoder:
    """Texts to ids and back, by a lexicon and exact merging of the words that it lacks."""

    def __init__(self, vocab: ByteVocabulary, lexicon: Lexicon):
        self.vocab, self.lexicon, self.cache = vocab, lexicon, {}
        self.decimal = [str(i) for i in range(len(vocab.bytes))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        parts, n_parts = texts, None
        for content, special in self.vocab.special.items():  # at most one
            if any(content in t for t in texts):
                cut = [t.split(content) for t in texts]
                parts, n_parts, special_id = [p for x in cut for p in x], np.array([len(x) for x in cut]), special
        done = [self._batch(parts[lo:hi]) for lo, hi in batches(parts)]
        ids = np.concatenate([x for x, _ in done]) if done else np.zeros(0, np.int32)
        counts = np.concatenate([x for _, x in done]) if done else np.zeros(0, np.int64)
        if n_parts is None:
            return ids, counts
        last = np.cumsum(n_parts) - 1
        inner = np.ones(len(parts), bool)
        inner[last] = False
        ids = np.insert(ids, np.cumsum(counts)[inner], special_id)
        return ids, np.add.reduceat(counts, last + 1 - n_parts) + n_parts - 1

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, starts, sizes, n_words = _words(texts)
        held, counts, known = self.lexicon.walk(data, starts, sizes)
        unseen = np.flatnonzero(~held)
        merged = self._merged(data, starts[unseen], sizes[unseen])
        counts[unseen] = np.fromiter(map(len, merged), np.int64, len(merged))
        stop = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=stop[1:])
        ids = np.empty(stop[-1], np.int32)
        ids[spread(stop[:-1][held], counts[held])] = known
        ids[spread(stop[:-1][unseen], counts[unseen])] = np.fromiter(
            (i for x in merged for i in x), np.int32, int(counts[unseen].sum()))
        last = np.cumsum(n_words)
        return ids, stop[last] - stop[last - n_words]

    def _merged(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple]:
        raw, cache, out = data.tobytes() if len(starts) else b"", self.cache, []
        for a, n in zip(starts.tolist(), sizes.tolist(), strict=True):
            word = raw[a:a + n]
            ids = cache.get(word)
            if ids is None:
                ids = self.vocab.merge(word)
                if n <= WORD_BYTES:
                    if len(cache) >= CACHED_WORDS:
                        cache.clear()
                    cache[word] = ids
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes, special ids to their strings: bytes that are no UTF-8 become U+FFFD."""
        table = self.vocab.bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


# On Spark ------------------------------------------------------------------------------------------

def count_words(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """(word binary, n): how often each word of at most ``WORD_BYTES`` bytes occurs in the whole
    table. Tasks add up before the shuffle."""
    def count(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = list(vocabulary(tokenizer_path).special)
        held: Counter = Counter()
        for block in blocks:
            for lo, hi in column_batches(block.column(0)):
                texts = block.column(0).slice(lo, hi - lo).to_pylist()
                for content in special:
                    texts = [p for t in texts for p in (t.split(content) if content in t else (t,))]
                for word, n in _counted(texts):
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield _counts(held)
                    held.clear()
        yield _counts(held)

    found = docs.select(text_of(text_col).alias("_text")).mapInArrow(count, "word binary, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(texts: list[str]) -> Iterator[tuple[bytes, int]]:
    data, starts, sizes, _ = _words(texts)
    short = sizes <= WORD_BYTES
    starts, sizes = starts[short], sizes[short]
    raw = data.tobytes()
    return iter(Counter([raw[a:b] for a, b in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)]).items())


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                      names=["word", "n"])


def frequent_words(counts: DataFrame, most: int = LEXICON_WORDS) -> list[bytes]:
    """The words that occur most often, ``most`` of them or fewer: whole steps of a sixteenth of a
    doubling are taken as long as they fit, so only that many words ever reach the driver."""
    step = F.floor(F.log2("n") * 16)
    taken, least = 0, None
    for row in counts.filter("n > 1").groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        taken += row["count"]
        if taken > most:
            break
        least = row["step"]
    return [] if least is None else [bytes(r["word"]) for r in counts.filter(step >= least).filter("n > 1").select("word").collect()]


def share_lexicon(spark: SparkSession, words: list[bytes], tokenizer_path: str) -> str:
    """Compile words with their ids, write the file to the shared store and have Spark hand it to
    every executor; the name that workers open it by."""
    vocab = vocabulary(tokenizer_path)
    blob = compile_words([(w, vocab.merge(w)) for w in words])
    name = f"lexicon-{hashlib.sha256(blob).hexdigest()[:16]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{run_path(spark, 'lexicon')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        for at in range(0, len(blob), 1 << 20):
            out.write(bytearray(blob[at:at + (1 << 20)]))
    finally:
        out.close()
    if not any(f.endswith(f"/{name}") for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path.toString())
    return name


@functools.lru_cache(1)
def coder(tokenizer_path: str, lexicon_name: str) -> LexiconCoder:
    """One per Python worker; the file's pages are shared by all workers of a machine."""
    return LexiconCoder(vocabulary(tokenizer_path), Lexicon(SparkFiles.get(lexicon_name)))


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     most: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every whole text: digests of the decimal
    ids joined by commas and of the decoded text. ``tokenizer_path``: a file every executor has."""
    counts = materialize(count_words(docs, tokenizer_path, text_col), "lexicon-counts")
    name = share_lexicon(docs.sparkSession, frequent_words(counts, most), tokenizer_path)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = coder(tokenizer_path, name)
        for block in blocks:
            for lo, hi in column_batches(block.column(1)):
                ids, counts = it.encode(block.column(1).slice(lo, hi - lo).to_pylist())
                stops = np.cumsum(counts)
                encoded, decoded = [], []
                for a, b in zip((stops - counts).tolist(), stops.tolist(), strict=True):
                    decimal = ",".join([it.decimal[i] for i in ids[a:b].tolist()])
                    encoded.append(hashlib.sha256(decimal.encode()).hexdigest())
                    decoded.append(hashlib.sha256(it.decode(ids[a:b]).encode()).hexdigest())
                cols = [block.column(0).slice(lo, hi - lo), pa.array(counts, pa.int64()),
                        pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(id_col), text_of(text_col).alias("_text")).mapInArrow(run, schema)
