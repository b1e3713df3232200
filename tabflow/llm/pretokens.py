"""Splitting texts into the pieces that byte-level BPE encodes one by one, on numpy arrays.

``split`` gives the same pieces as matching the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` from left to
right: runs of letters, numbers or other characters with one blank before them, white space, and
the seven endings after an apostrophe. Instead of running the pattern it marks the boundaries of
all texts of a batch at once. ``PieceCoder`` gives the ids of all pieces: a batch's distinct pieces
are looked up in a bounded cache by hash, and only those not in it are encoded.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Set where Unicode versions may differ about a character; texts with one are split by the pattern.
UNSURE = 8
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that are split at a time.
BATCH_CHARS = 1 << 20
#: Longer pieces don't go through the cache.
LONG_PIECE = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


@functools.lru_cache(1)
def char_classes() -> np.ndarray:
    """For each code point its class, plus UNSURE for those that became (or may become) letters,
    numbers or white space after Unicode 3.2."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    place = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[place[m.start():m.end()]] = kind
    old = unicodedata.ucd_3_2_0.category
    late = np.fromiter((old(c) == "Cn" for c in every), bool, len(every))
    now_unknown = np.zeros(len(every), bool)
    for m in regex.finditer(r"\p{Cn}+", every):
        now_unknown[m.start():m.end()] = True
    unsure = late & ((out[place] != OTHER) | now_unknown)
    out[place[unsure]] |= UNSURE
    return out


@functools.lru_cache(1)
def _char_hashes() -> np.ndarray:
    x = np.arange(1, 0x110001, dtype=np.uint64) * _BASE
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@functools.lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    odd = 0xD1342543DE82EF95
    inverse = pow(odd, -1, 1 << 64)
    up, down = np.full(n, odd, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def batches(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``most`` characters each, one text at least."""
    at, chars = 0, 0
    for i, t in enumerate(texts):
        if i > at and chars + len(t) > most:
            yield at, i
            at, chars = i, 0
        chars += len(t)
    if at < len(texts):
        yield at, len(texts)


def column_batches(texts: pa.Array, most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """The same for an Arrow column without nulls, by bytes and without taking the texts out."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, to
        at = to


def split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts in a row, where pieces start, number of pieces of each text)."""
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    n = len(code)
    if not n:
        return code, np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    kind = char_classes()[code]
    unsure = kind >= UNSURE
    doubtful = np.unique(np.searchsorted(ends, np.flatnonzero(unsure), "right")) if unsure.any() else []
    kind &= 3
    first = np.zeros(n + 1, bool)
    first[(ends - sizes)[sizes > 0]] = True
    first[n] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(start[:n])
    after = np.append(runs[1:], n)
    # white space before something: its last character is split off, a blank goes with what follows
    gap = (kind[runs] == SPACE) & ~first[after]
    last, nxt = after[gap] - 1, after[gap]
    start[last] = True
    start[nxt[code[last] == 0x20]] = False
    # an apostrophe alone before letters takes one of the seven endings
    lone = np.flatnonzero((code[runs] == 0x27) & (after - runs == 1) & ~first[after] & start[runs])
    lone = lone[lone + 1 < len(runs)]
    lone = lone[kind[runs[lone + 1]] == LETTER]
    if len(lone):
        at, stop = runs[lone] + 1, after[lone + 1]
        a = code[at]
        b = np.where(at + 1 < stop, code[np.minimum(at + 1, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        took = one * 1 + (two & ~one) * 2
        hit = took > 0
        start[at[hit]] = False
        cut = at[hit] + took[hit]
        start[cut[cut < stop[hit]]] = True
    for d in doubtful:  # exact for any version of the tables: the pattern itself
        lo, hi = ends[d] - sizes[d], ends[d]
        start[lo:hi] = False
        start[[lo + m.start() for m in regex.finditer(PATTERN, texts[d])]] = True
    starts = np.flatnonzero(start[:n])
    counts = np.searchsorted(starts, ends) - np.searchsorted(starts, ends - sizes)
    return code, starts, counts


def split_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for words with the blanks before them; a text's last word has those after it too."""
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[sizes > 0]
    blank = code == 0x20
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[begins] = True
    starts = np.flatnonzero(start)
    last = ends[sizes > 0] - 1
    closing = starts[np.searchsorted(starts, last, "right") - 1]  # each text's last start
    start[closing[blank[last] & (closing != begins)]] = False
    starts = np.flatnonzero(start)
    return code, starts, np.searchsorted(starts, ends) - np.searchsorted(starts, ends - sizes)


def piece_hashes(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece from prefix sums of a polynomial over its code points."""
    up, down = _powers(1 << max(20, int(len(code)).bit_length()))
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(_char_hashes()[code] * up[:len(code)], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= (ends - starts).astype(np.uint64) * _BASE
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def spread(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the elements of runs that start at ``offsets``."""
    total = np.cumsum(lengths)
    return np.repeat(offsets - (total - lengths), lengths) + np.arange(total[-1] if len(total) else 0)


def distinct_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``np.unique`` gives with index and inverse; only distinct values are sorted."""
    found = pa.array(h).dictionary_encode()
    values, at = found.dictionary.to_numpy(), found.indices.to_numpy()
    first = np.empty(len(values), np.int64)
    first[at[::-1]] = np.arange(len(at) - 1, -1, -1)
    order = np.argsort(values)
    place = np.empty(len(values), np.int64)
    place[order] = np.arange(len(values))
    return values[order], first[order], place[at]


class PieceCoder:
    """ids of texts, by pieces as ``split`` cuts them. ``encode`` gives the ids of each of a list of
    distinct pieces: a list for each, or (all ids in a row, number of ids of each).

    The cache holds about ``limit`` pieces. When it is full, those met in most batches stay, half of
    ``limit`` at most: its memory is bounded and its state never changes a result."""

    def __init__(self, encode: Callable[[list[str]], list | tuple], limit: int = 1 << 19, whole: Callable | None = None,
                 special: str | None = None, split: Callable = split):
        self.encode, self.limit, self.whole, self.special, self.split = encode, limit, whole, special, split
        self._clear()

    def _clear(self):
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.slots = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.offsets, self.lengths, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0
        self.met = np.zeros(1024, np.int32)  # batches that found the piece
        self.ids, self.filled = np.zeros(4096, np.uint32), 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        for keys, slots in zip(self.keys, self.slots, strict=True):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                out[hit] = slots[at[hit]]
        return out

    def _store(self, pieces: list[str]) -> np.ndarray:
        """Encode pieces and keep their ids; their slots."""
        got = self.encode(pieces)
        if isinstance(got, tuple):
            ids, lengths = got
        else:
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter((i for x in got for i in x), np.uint32, int(lengths.sum()))
        return self._keep(ids, lengths)

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, total = self.used + len(lengths), self.filled + len(ids)
        if n > len(self.offsets):
            self.offsets, self.lengths, self.met = (np.resize(x, max(n, 2 * len(x)))
                                                    for x in (self.offsets, self.lengths, self.met))
        if total > len(self.ids):
            self.ids = np.resize(self.ids, max(total, 2 * len(self.ids)))
        self.offsets[self.used:n] = self.filled + np.cumsum(lengths) - lengths
        self.lengths[self.used:n] = lengths
        self.met[self.used:n] = 0
        self.ids[self.filled:total] = ids
        slots = np.arange(self.used, n)
        self.used, self.filled = n, total
        return slots

    def _thin(self) -> None:
        """Forget pieces that no batch met again, and the rarer ones beyond half of the limit."""
        keys, slots = np.concatenate(self.keys), np.concatenate(self.slots)
        met, room = self.met[slots], max(1, self.limit // 2)
        kept = np.flatnonzero(met)
        if len(kept) > room:
            kept = kept[np.argpartition(met[kept], len(kept) - room)[len(kept) - room:]]
        kept = kept[np.argsort(keys[kept])]
        keys, met, slots = keys[kept], met[kept], slots[kept]
        lengths = self.lengths[slots]
        ids = self.ids[spread(self.offsets[slots], lengths)]
        self._clear()
        slots = self._keep(ids, lengths)
        self.met[slots] = met >> 1  # what was met long ago counts less
        self.keys[0], self.slots[0] = keys, slots

    def _remember(self, h: np.ndarray, slots: np.ndarray) -> None:
        for level in (1, 0):  # new pieces go to a small table, which now and then joins the large one
            keys, kept = np.concatenate([self.keys[level], h]), np.concatenate([self.slots[level], slots])
            order = np.argsort(keys, kind="stable")
            self.keys[level], self.slots[level] = keys[order], kept[order]
            if level == 0 or len(keys) < 1 << 15:
                return
            h, slots = self.keys[1], self.slots[1]
            self.keys[1], self.slots[1] = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        parts, counts = [], np.zeros(len(texts), np.int64)
        for lo, hi in batches(texts):
            ids, n = self._batch(texts[lo:hi])
            parts.append(ids)
            counts[lo:hi] = n
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), counts

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.special and any(self.special in t for t in texts):
            # the library treats this string before it splits: such texts are encoded by it whole
            plain, rest = [], []
            for i, t in enumerate(texts):
                (rest if self.special in t else plain).append(i)
            ids, n = self._batch([texts[i] for i in plain])
            found = dict(zip(plain, np.split(ids, np.cumsum(n)[:-1]), strict=True)) if plain else {}
            found |= {i: np.asarray(x, np.uint32) for i, x in zip(rest, self.whole([texts[i] for i in rest]), strict=True)}
            out = [found[i] for i in range(len(texts))]
            return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))
        if self.used > self.limit:
            self._thin()
        code, starts, counts = self.split(texts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ends = np.append(starts[1:], len(code))
        h = piece_hashes(code, starts, ends)
        distinct, first, back = distinct_of(h)
        long = np.flatnonzero(ends - starts > LONG_PIECE)
        if len(long):  # every long piece stands for itself
            back = back.copy()
            back[long] = len(distinct) + np.arange(len(long))
            used = np.zeros(len(distinct) + len(long), bool)
            used[back] = True
            first = np.concatenate([first, long])
        else:
            used = np.ones(len(distinct), bool)
        slots = np.full(len(used), -1, np.int64)
        slots[:len(distinct)] = self._find(distinct)
        self.met[slots[slots >= 0]] += 1
        missing = np.flatnonzero((slots < 0) & used)
        if len(missing):
            at = first[missing]
            sizes = ends[at] - starts[at]
            joined = code[spread(starts[at], sizes)].tobytes().decode("utf-32-le")
            stops = np.cumsum(sizes)
            pieces = [joined[a:b] for a, b in zip((stops - sizes).tolist(), stops.tolist(), strict=True)]
            slots[missing] = got = self._store(pieces)
            cached = missing < len(distinct)
            self._remember(distinct[missing[cached]], got[cached])
        slot = slots[back]
        lengths = self.lengths[slot]
        ids = self.ids[spread(self.offsets[slot], lengths)]
        of_text = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths, out=of_text[1:])
        stop = np.cumsum(counts)
        return ids, of_text[stop] - of_text[stop - counts]
