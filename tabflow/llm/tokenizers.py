"""Public tokenizers by the file they are kept in; one instance per Python worker and file."""

from __future__ import annotations

import functools
import hashlib
import os

import numpy as np

from tabflow.llm.pretokens import PieceCoder, spread

#: White space by code point; the last entry stands for all above.
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])


def version_digest(path: str) -> str:
    """A digest of the tokenizer's file and its library's version: what stored counts depend on."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    h = hashlib.sha256(f"{library.__name__} {library.__version__} ".encode())
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def piece_encoder(tokenizer):
    """A function from distinct pieces of a byte-level vocabulary, which splits texts before it merges, to
    (ids of all pieces in a row, number of ids of each), as the library encodes each piece alone.

    A call of the library for each piece costs more than its merges, so pieces of no white space but a
    blank in front go as one text: what the pattern takes of them does not depend on what follows, and
    a line feed before those without a blank is a piece of its own. Where each one's tokens end is
    found by their bytes; should a piece not end with a token, all are encoded alone."""
    # a byte-level token has a character for each byte
    sizes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())], np.int64)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def alone(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)])

    def joined(pieces: list[str], blank: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        text = "".join([p if b else "\n" + p for p, b in zip(pieces, blank.tolist(), strict=True)])
        if any(s in text for s in special):
            return None
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(length + ~blank)
        at = np.append(0, np.cumsum(sizes[ids]))
        first, stop = np.searchsorted(at, ends - length), np.searchsorted(at, ends)
        if at[-1] != ends[-1] or (at[first] != ends - length).any() or (at[stop] != ends).any():
            return None
        return ids[spread(first, stop - first)], stop - first

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not pieces or "" in pieces:
            return alone(pieces)
        code = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begins = np.cumsum(chars) - chars
        blank = code[begins] == 0x20
        space = _SPACE[np.minimum(code, len(_SPACE) - 1)]
        # no white space but a blank in front
        plain = (np.add.reduceat(space, begins, dtype=np.int64) == blank) & (chars > blank)
        more = (code > 0x7F).astype(np.uint8) + (code > 0x7FF) + (code > 0xFFFF)
        length = chars + np.add.reduceat(more, begins, dtype=np.int64)
        fit = pieces if plain.all() else [p for p, ok in zip(pieces, plain.tolist(), strict=True) if ok]
        found = joined(fit, blank[plain], length[plain]) if fit else None
        if found is None:
            return alone(pieces)
        if plain.all():
            return found
        ids, counts = alone([p for p, ok in zip(pieces, plain.tolist(), strict=True) if not ok])
        lengths, offsets = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        lengths[plain], lengths[~plain] = found[1], counts
        offsets[plain] = np.cumsum(found[1]) - found[1]
        offsets[~plain] = len(found[0]) + np.cumsum(counts) - counts
        return np.concatenate([found[0], ids])[spread(offsets, lengths)], lengths

    return encode


@functools.lru_cache(4)
def text_coder(path: str):
    """A function from texts to (ids of all texts in a row, number of ids of each), as the library
    gives them without added begin or end tokens.

    A byte-level vocabulary that splits texts before it merges gives each piece's ids on their own,
    so distinct pieces of a batch are encoded once (by the library) and cached; texts with one of
    its special strings, and vocabularies of other kinds, go to the library whole."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        return lambda texts: _flat(model.encode(texts, num_threads=1))
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(texts: list[str]) -> list:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    splitter = tokenizer.pre_tokenizer
    if (tokenizer.normalizer is None and isinstance(splitter, ByteLevel) and not splitter.add_prefix_space
            and splitter.use_regex and len(special) <= 1):
        return PieceCoder(piece_encoder(tokenizer), limit=1 << 20, whole=whole, special=special[0] if special else None)
    return lambda texts: _flat(whole(texts))


def _flat(ids: list) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for x in ids for i in x), np.uint32, int(counts.sum())), counts
