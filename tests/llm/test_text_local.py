"""Parts that need no Spark: pieces, merges, wavelet matrices, digests, trigram queries."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tabflow.llm import fingerprints, jaccard, langid, secrets, topk, wavelet
from tabflow.llm.bpe import coder
from tabflow.llm.pretokens import PATTERN, split
from tabflow.llm.tokenizers import text_coder

ALPHABET = list("abst'rvelmd  \n\t012!?.") + ["é", "ß", "日", " ", " ", "\x1c", "٣", "Ⅷ", "😀", "́", "Ა",
                                             "\U0001F9FF", "\U00030000", "￿"]
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


def _pieces(texts):
    code, starts, counts = split(texts)
    ends = np.append(starts, len(code))[1:]
    words = [code[a:b].tobytes().decode("utf-32-le") for a, b in zip(starts, ends, strict=True)]
    stops = np.cumsum(counts)
    return [words[a:b] for a, b in zip(stops - counts, stops, strict=True)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=30), max_size=8))
def test_pieces_are_the_patterns_matches(texts):
    assert PATTERN == P.PATTERN
    assert _pieces(texts) == [regex.findall(P.PATTERN, t) for t in texts]


@pytest.mark.parametrize("text", ["", "'", "''s", "'sabc'd", "a's b're c'll", "  ", "x  ", "\n\n a", "a 's", "5's", "'s"])
def test_pieces_of_endings_and_blanks(text):
    assert _pieces(["a", text, "b"]) == [["a"], regex.findall(P.PATTERN, text), ["b"]]


def _tiktoken():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_match_the_library():
    rnd, reference = random.Random(3), _tiktoken()
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(60))) for _ in range(1500)]
    texts += ["", "a" * 3000, "".join(rnd.choice("abcdef") for _ in range(2000)), "=-" * 400,
              "".join(rnd.choice("thequickaeio") for _ in range(255)), "<|endoftext|>"]
    pairs, pieces = coder(RANKS)
    ids, counts = pieces(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert pairs.decode(ids, counts) == [t.encode() for t in texts]


def test_cache_that_overflows_changes_nothing():
    from tabflow.llm.pretokens import PieceCoder
    pairs, _ = coder(RANKS)
    texts = [f"word{i} other{i % 7}" for i in range(500)]
    small = PieceCoder(pairs.encode, limit=3)
    ids = np.concatenate([small([t])[0] for t in texts])
    assert ids.tolist() == PieceCoder(pairs.encode)(texts)[0].tolist()


def test_full_cache_keeps_what_is_met_often():
    from tabflow.llm.pretokens import PieceCoder
    pairs, _ = coder(RANKS)
    sent = []

    def encode(pieces):
        sent.extend(pieces)
        return pairs.encode(pieces)

    texts = [f"a common word x{i}y z{i}w" for i in range(60)]
    small = PieceCoder(encode, limit=20)
    ids = np.concatenate([small([t])[0] for t in texts])
    assert ids.tolist() == PieceCoder(pairs.encode)(texts)[0].tolist()
    assert sent.count(" common") == 1
    assert small.used <= 20 + 9  # the limit and a text's pieces
    one = PieceCoder(pairs.encode, limit=1)
    assert np.concatenate([one([t])[0] for t in texts]).tolist() == ids.tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 3), min_size=1, max_size=40))
def test_distinct_values(values):
    from tabflow.llm.pretokens import distinct_of
    h = np.array(values, np.uint64)
    assert [x.tolist() for x in distinct_of(h)] == [x.tolist() for x in np.unique(h, return_index=True, return_inverse=True)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_library_ids(name):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(50))) for _ in range(300)]
    texts += ["", "one <|endoftext|> two", "<|endoftext|>", "x" * 500]
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        expected = SentencePieceProcessor(model_file=P.path(name)).encode(texts)
    else:
        from tokenizers import Tokenizer
        expected = [e.ids for e in Tokenizer.from_file(P.path(name)).encode_batch(texts, add_special_tokens=False)]
    ids, counts = text_coder(P.path(name))(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


@pytest.mark.parametrize("size,most", [(0, 1), (1, 0), (511, 5), (512, 300), (1025, 50256), (3000, 70000)])
def test_wavelet_matrix(size, most):
    ids = np.random.Generator(np.random.PCG64(size)).integers(0, most + 1, size).astype(np.uint32)
    counts = np.array([size // 2, size - size // 2])
    m = wavelet.WaveletMatrix(wavelet.build(ids, [None, -7], counts))
    assert m.decode().tolist() == ids.tolist()
    assert m.documents()[0] == [None, -7] and m.documents()[1].tolist() == counts.tolist()
    for i in range(0, size, max(1, size // 17)):
        token = int(ids[i])
        assert m.access(i) == token
        assert m.count(token) == (ids == token).sum()
        assert m.count(token, i, size) == (ids[i:] == token).sum()
        assert m.locate(token) == np.flatnonzero(ids == token).tolist()
    assert m.count(1 << 20) == 0 and m.locate(-1) == []
    with pytest.raises(IndexError):
        m.access(size)


def _buckets(raw):
    """Triplets one by one."""
    out = np.zeros(256, np.int64)
    for e in range(len(raw)):
        for (i, j, k), (x, y, z) in zip(fingerprints.TRIPLETS, fingerprints._TABLES, strict=True):
            if e >= 4 - k and e >= 4 - min(i, j, k):
                out[x[raw[e]] ^ y[raw[e - (4 - j)]] ^ z[raw[e - (4 - k)]]] += 1
    return out


@pytest.mark.parametrize("part", [7, 1 << 20])
def test_digest_by_parts(part, monkeypatch):
    monkeypatch.setattr(fingerprints, "_PART", part)
    for raw in (b"", b"ab", b"abc", b"some words, some more words " * 4, "größe".encode() * 9):
        d, c = fingerprints.digest(raw), _buckets(raw)
        quartiles = np.sort(c)[[63, 127, 191]]
        assert d[:256].tolist() == sum((c > q).astype(int) for q in quartiles).tolist()
        assert fingerprints.from_text(fingerprints.to_text(d)).tolist() == d.tolist()
        assert fingerprints.likeness(d, d) == 1.0
    assert 0 <= fingerprints.likeness(fingerprints.digest(b"abc" * 50), fingerprints.digest(b"xyz" * 5)) <= 1


def test_shingles():
    one = jaccard.shingles("A b\tC\x0bd e")
    assert len(one) == 2 and one.tolist() == jaccard.shingles("a B c  d\ne").tolist()
    assert len(jaccard.shingles("x y")) == 1 and len(jaccard.shingles(" \n")) == 0
    assert jaccard.shingles("x y").tolist() != jaccard.shingles("y x").tolist()
    assert len(jaccard.shingles("Ä b c d")) == 1 and jaccard.shingles("Ä").tolist() != jaccard.shingles("ä").tolist()


def test_presence_by_parts(monkeypatch):
    raw = ("größe und länge " * 30).encode()
    whole, parts = (np.zeros(1 << langid.FEATURE_BITS, np.uint8) for _ in range(2))
    langid.present(raw, whole)
    monkeypatch.setattr(langid, "_PART", 11)
    langid.present(raw, parts)
    assert (whole == parts).all() and whole.sum() > 10
    assert not langid.has_letter("12 !") and not langid.has_letter(None) and langid.has_letter("1é")


def test_trigram_queries_hold_for_matches():
    def holds(q, text):
        if q is True:
            return True
        if isinstance(q, str):
            return q in text
        return (all if q[0] == "and" else any)(holds(x, text) for x in q[1])

    samples = {"assign": ["PassWord = 'abcdefgh'", 'api_key":"x', "token=1"], "access": ["AKIA0123456789AB"],
               "pem": ["-----BEGIN RSA PRIVATE KEY-----"], "forge": ["ghp_" + "a" * 36], "hex": ["0" * 32],
               "jwt": ["eyJabcdefgh.eyJabcdefgh.abcdefgh"]}
    for rule in secrets.RULES:
        q = secrets.trigram_query(rule.pattern)
        assert all(holds(q, s.lower()) for s in samples[rule.kind])
        assert (q is True) == (rule.kind == "hex")
    assert not holds(secrets.trigram_query(secrets.BASE[0].pattern), "no such word: ass ken ret")


def test_products_are_exact():
    a = np.array([[2 ** 30, 3], [-5, 7]], np.int64)
    assert topk.products(a, a).tolist() == [[2 ** 60 + 9, -5 * 2 ** 30 + 21], [-5 * 2 ** 30 + 21, 74]]
    assert topk.products(np.array([[2 ** 62]]), np.array([[2 ** 62]])).tolist() == [[2 ** 63 - 1]]
    assert topk._components([[1e30, -1e30, 0.5]], 64.0).tolist() == [[2 ** 63 - 1, -(2 ** 63 - 1), 32]]


def _search(v, k, coordinate_from):
    old, topk.COORDINATE_FROM = topk.COORDINATE_FROM, coordinate_from
    try:
        ids = np.arange(len(v), dtype=np.int64)
        norms = topk._norms(v)
        order = np.lexsort((ids, -norms))
        buckets = []
        for lo in range(0, len(v), 16):
            o = order[lo:lo + 16]
            buckets.append((ids[o], ids[o], v[o], norms[o], v[o] / np.where(norms[o] > 0, norms[o], 1)[:, None]))
        best = topk.Best(len(v), k)
        topk.search(buckets, (ids, ids, v), best, np.full(len(v), -np.inf))
        return [best.ids[i, :best.filled[i]].tolist() for i in range(len(v))]
    finally:
        topk.COORDINATE_FROM = old


@pytest.mark.parametrize("coordinate_from", [-1.0, 0.5, 2.0])
@pytest.mark.parametrize("kind", ["spread", "ties", "few"])
def test_bucket_search_matches_brute_force(coordinate_from, kind):
    rnd = np.random.Generator(np.random.PCG64(7))
    v = rnd.integers(-50, 50, (150, 8))
    if kind == "ties":
        v[::3] = v[0]
        v[5] = 0
    if kind == "spread":
        v = v * rnd.integers(1, 40, (150, 1))
    if kind == "few":
        v = v[:4]
    s = v @ v.T
    expected = [[j for j in sorted(range(len(v)), key=lambda j: (-s[i, j], j)) if j != i][:20] for i in range(len(v))]
    assert _search(v, 20, coordinate_from) == expected


def test_fine_parts_bound_the_intersection():
    from tabflow.llm import jaccard
    rnd = np.random.default_rng(8)
    for n, m in ((300, 350), (1000, 1100), (4000, 4500), (9000, 9500)):
        common = rnd.integers(0, 2 ** 63, n // 2, dtype=np.uint64)
        a, b = (np.unique(np.append(common, rnd.integers(0, 2 ** 63, k - n // 2, dtype=np.uint64))) for k in (n, m))
        x, y = sorted((np.frombuffer(jaccard._fine(s), np.uint8) for s in (a, b)), key=len)
        most = np.minimum(x, y.reshape(-1, len(x)).sum(0, dtype=np.int64)).sum()
        assert len(np.intersect1d(a, b)) <= most
        assert 185 * most < 85 * (len(a) + len(b))  # sets that share half are told from similar ones
    assert jaccard._fine(np.arange(256, dtype=np.uint64)) is None
    assert jaccard._fine(np.arange(2000, dtype=np.uint64) * 1024) is None  # more than a byte holds in one part


def test_pieces_go_to_the_library_as_one_text():
    from tokenizers import Tokenizer

    from tabflow.llm.tokenizers import piece_encoder
    tokenizer, sent = Tokenizer.from_file(JSON), []

    class Recorder:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    pieces = [" house", "house", "'s", ",", " !?", "١٢", " 日本", "é", "\n\n", "  ", "\u180e", " " + "x" * 300]
    ids, counts = piece_encoder(Recorder())(pieces)
    alone = [e.ids for e in tokenizer.encode_batch(pieces, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, alone)) and ids.tolist() == [i for x in alone for i in x]
    assert len(sent) == 3  # one text, and the two pieces of white space


def test_pieces_of_any_width_and_white_space():
    from tokenizers import Tokenizer

    from tabflow.llm.tokenizers import piece_encoder
    tokenizer = Tokenizer.from_file(JSON)
    pieces = ["a", " ", " é", "日本", " 😀", "\x85", "\u3000", " \u2003", "\x1c", "\U0001F9FF", "a b", "\ta", " <|", "|>", "ß" * 200]
    for some in (pieces, pieces[::-1], [" "], ["😀"], []):
        ids, counts = piece_encoder(tokenizer)(some)
        alone = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, alone)) and ids.tolist() == [i for x in alone for i in x]


def test_fit_holds_few_texts_at_a_time():
    import tracemalloc
    rnd = np.random.default_rng(3)
    x = (rnd.random((800, 1 << langid.FEATURE_BITS)) < 0.05).astype(np.uint8)
    labels = ["a", "b"] * 400
    x[::2, :4000] = 1
    tracemalloc.start()
    model = langid.Model(x, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6  # all rows as floats are 105 MB
    assert model.predict(x[:6])[0] == labels[:6]
    again = langid.Model(np.packbits(x, axis=1), labels)
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.landmarks, again.landmarks)
