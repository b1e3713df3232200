"""Token alignment, periodic runs and the lexicon transducer, each against a brute-force version or
the library, on the table of ``test_text_spark`` (nulls, repeats, empty and long texts, clashing names)."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from test_text_spark import ROWS, docs  # noqa: F401
from tokenizers import Tokenizer

from tabflow.llm import alignment, periodic, transducer
from tabflow.llm.registry import with_period

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Lexicon ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("most", [0, 50, 1 << 16])
def test_lexicon_encodes_as_the_library_whatever_it_holds(spark, docs, most):  # noqa: F811
    library = Tokenizer.from_file(BYTE)
    want = Counter()
    for i, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, transducer.encode_documents(docs, BYTE, most=most).collect())) == want


def test_lexicon_of_an_empty_table(spark, docs):  # noqa: F811
    assert transducer.encode_documents(docs.limit(0), BYTE).count() == 0


def test_word_counts_cover_the_table(spark, docs):  # noqa: F811
    got = {bytes(r["word"]): r["n"] for r in transducer.count_words(docs, BYTE).collect()}
    split, special = Tokenizer.from_file(BYTE).pre_tokenizer, "<|endoftext|>"
    letters = transducer._byte_letters()
    want = Counter(bytes(letters[c] for c in piece) for _, t, *_ in ROWS for part in (t or "").split(special)
                   for piece, _ in split.pre_tokenize_str(part))
    assert got == {w: n for w, n in want.items() if len(w) <= transducer.WORD_BYTES}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 4), min_size=1, max_size=4).map(tuple), max_size=40),
       st.lists(st.binary(max_size=7), max_size=20))
def test_transducer_gives_each_word_its_ids(tmp_path_factory, words, others):
    path = tmp_path_factory.mktemp("lexicon") / "l.bin"
    path.write_bytes(transducer.compile_words(list(words.items())))
    asked = [*words, *others]
    data = np.frombuffer(b"".join(asked) + b"\0", np.uint8)
    sizes = np.array([len(w) for w in asked], np.int64)
    held, counts, ids = transducer.Lexicon(str(path)).walk(data, np.cumsum(sizes) - sizes, sizes)
    assert held.tolist() == [w in words for w in asked]
    assert ids.tolist() == [i for w in asked if w in words for i in words[w]]
    assert counts.tolist() == [len(words.get(w, ())) for w in asked]


def test_transducer_shares_endings():
    words = [(f"{a}{b}ing".encode(), (i,)) for i, (a, b) in enumerate((a, b) for a in "abcd" for b in "wxyz")]
    states = {len(transducer.compile_words(words[:n])) for n in (1, 16)}
    # 16 words of 5 bytes share their last three bytes and the states before them where the ids allow
    trie = sum(len({w[:k] for w, _ in words}) for k in range(6))
    assert trie == 1 + 4 + 16 * 4
    assert len(states) == 2
    assert _states(words) == 1 + 4 + 1 + 1 + 1 + 1  # root, one a first letter, then "ing" once


def _states(words):
    import json
    blob = transducer.compile_words(words)
    return json.loads(blob[8:8 + int.from_bytes(blob[:8], "little")])["arrays"]["bits"][1][0]


def test_long_words_merge_as_the_library():
    vocab, library, rnd = transducer.vocabulary(BYTE), Tokenizer.from_file(BYTE), random.Random(3)
    for n in (41, 200, 3000):
        for letters in ("a", "ab", "etaoinshrdlu"):
            word = "".join(rnd.choice(letters) for _ in range(n))
            assert list(vocab.merge(word.encode())) == library.encode(word, add_special_tokens=False).ids
            assert vocab._merge_long(word[:30].encode()) == vocab.merge(word[:30].encode())


# Alignment ----------------------------------------------------------------------------------------

ENDS = st.lists(st.integers(1, 60), unique=True, max_size=40)


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS)
def test_diagonal_groups_against_sets(a, b):
    a, b = (sorted({*x, 61}) for x in (a, b))
    one, odd, link_a, link_b = alignment.diagonal_groups(np.array(a), np.array(b))
    cuts = sorted({a[i + k] for i, _, s in one for k in range(s)} | {a[i2 - 1] for _, i2, _, _ in odd})
    assert cuts == sorted(set(a) & set(b))
    assert all(a[i:i + s] == b[j:j + s] for i, j, s in one)
    got = {(i + k, j + k) for i, j, s in one for k in range(s)} | set(zip(link_a, link_b, strict=True))
    starts = ([0, *a[:-1]], [0, *b[:-1]])
    want = {(i, j) for i in range(len(a)) for j in range(len(b))
            if max(starts[0][i], starts[1][j]) < min(a[i], b[j])}
    assert got == want
    assert len(link_a) + sum(s for _, _, s in one) == len(want)


def _tokens(text):
    """(ids, ends) of both vocabularies, None where one doesn't give the bytes back."""
    library, model = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    library.encode_special_tokens = True
    table, raw = transducer.vocabulary(BYTE).bytes, (" " + text).encode()
    out = []
    for ids, of in ((library.encode(" " + text, add_special_tokens=False).ids, lambda i: table[i]),
                    (model.encode(text), lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
                     else model.id_to_piece(i).replace("▁", " ").encode())):
        if b"".join(map(of, ids)) != raw or not text:
            return None
        out.append((ids, np.cumsum([len(of(i)) for i in ids]).tolist()))
    return out


def test_alignment_against_brute_force(spark, docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2000)  # many blocks
    texts = {t for _, t, *_ in ROWS if t}
    known = {t: _tokens(t) for t in texts}
    of_text, total = {}, Counter()
    for t, found in known.items():
        groups, links = [], Counter()
        if found:
            (a, ea), (b, eb) = found
            i = j = 0
            for cut in sorted(set(ea) & set(eb)):
                i2, j2 = ea.index(cut) + 1, eb.index(cut) + 1
                groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
                i, j = i2, j2
            for x in range(ea[-1]):  # bytes where a link begins: where a token of either does
                if x in {0, *ea, *eb}:
                    links[a[next(k for k, e in enumerate(ea) if e > x)], b[next(k for k, e in enumerate(eb) if e > x)]] += 1
        of_text[t] = (found, groups, links)
    for _, t, *_ in ROWS:
        total.update(of_text[t][2] if t else {})
    top = Counter()
    for (_, y), n in total.items():
        top[y] = max(top[y], n)
    want = Counter()
    for i, t, *_ in ROWS:
        found, groups, links = of_text[t] if t else (None, [], Counter())
        want[i, len(found[0][0]) if found else 0, len(found[1][0]) if found else 0, len(groups), links.total(),
             sum(n for p, n in links.items() if total[p] == top[p[1]]), sum(n * total[p] for p, n in links.items()),
             sha(";".join(groups)) if groups else ""] += 1
    assert Counter(map(tuple, alignment.link_statistics(docs, BYTE, PIECE).collect())) == want


def test_alignment_gives_tokens_and_groups(spark, docs):  # noqa: F811
    rows = alignment.align_documents(docs.filter("doc_id in (300, 301, 307, 403)"), BYTE, PIECE).collect()
    for r in rows:
        text = next(t for i, t, *_ in ROWS if i == r["doc_id"])
        found = _tokens(text) if text else None
        if not found:
            assert not r["a_ids"] and not r["b_ids"] and not r["a_ends"]
            continue
        (a, ea), (b, eb) = found
        assert (r["a_ids"], r["b_ids"]) == (a, b)
        assert [ea[i - 1] for i in r["a_ends"]] == [eb[j - 1] for j in r["b_ends"]] == sorted(set(ea) & set(eb))


def test_alignment_of_special_strings_and_unfit_texts(spark):
    data = [(1, "a <|endoftext|> b <s> </s>"), (2, "x▁y"), (3, "two  blanks\n\tand <0x41>"), (4, "")]
    rows = {r["doc_id"]: r for r in alignment.link_statistics(spark.createDataFrame(data, "doc_id long, text string"), BYTE, PIECE).collect()}
    assert rows[2]["n_a"] == rows[4]["n_links"] == 0 and rows[2]["groups_sha256"] == ""
    assert rows[1]["n_a"] > 8 and rows[3]["n_groups"] > 4
    assert alignment.link_statistics(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).count() == 0


# Periodic runs ------------------------------------------------------------------------------------

def _runs(w):
    """Every run by definition, as (start, period, length)."""
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and not any(w[i:j + q - p] == w[i + p:j + q] for p in range(1, q)):
                out.add((i, q, j + q - i))
            i = j + 1
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 9)), max_size=6), max_size=4))
def test_runs_against_their_definition(parts):
    texts = [[c for letters, n in t for c in letters * n] for t in parts]
    text, start, length, period = periodic.runs_of(periodic.word_codes(texts), np.array([len(t) for t in texts], np.int64))
    assert list(zip(text.tolist(), start.tolist(), period.tolist(), length.tolist(), strict=True)) == \
        [(k, *r) for k, t in enumerate(texts) for r in _runs(t)]


def test_runs_of_documents(spark, docs):  # noqa: F811
    line = " ".join(f"w{i}" for i in range(7))
    extra = [(900 + i, t, "en", "s", 0, "c", 1, 2) for i, t in enumerate(
        ["no " * 3, "no " * 6, "x " + (line + "\n") * 4 + "y", (line + " ") * 3, "a b a b a b a b c c c c c c c", "é " * 4000])]
    table = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    want = Counter()
    for i, t, *_ in [*ROWS, *extra]:
        w = with_period(i, re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        runs = _runs(w) if len(w) < 1500 else sorted((s, q, n) for s, q, n in [(0, 1, len(w))] if len(set(w)) == 1)
        gone = {k for s, q, n in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
        want[i, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
             sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    found = periodic.find_runs(table, edit=with_period)
    got = Counter(map(tuple, periodic.report(found).collect()))
    long = {i for i, t, *_ in [*ROWS, *extra] if t and len(t.split()) >= 1500 and len(set(t.split())) > 1}
    assert {k: n for k, n in got.items() if k[0] not in long} == {k: n for k, n in want.items() if k[0] not in long}
    assert sum(got.values()) == len(ROWS) + len(extra)
    kept = {r["doc_id"]: r["collapsed"] for r in periodic.find_runs(table).filter(F.col("doc_id") >= 900).collect()}
    assert kept[900] == "no no no" and kept[901] == "no" and kept[902] == f"x {line} y" and kept[904] == "a b c"
    assert periodic.report(periodic.find_runs(docs.limit(0))).count() == 0


def test_planted_period():
    words = [str(i) for i in range(50)]
    for i in range(60):
        got, h = with_period(i, words), zlib.crc32(str(i).encode())
        if h % 10:
            assert got == words
        else:
            a = h // 10 % 50
            p = 1 + (50 - a) // (3 + h // 10 % 8)
            assert got == [words[k] if k < a else words[a + (k - a) % p] for k in range(50)]
    assert with_period(None, words) == words and with_period(5, []) == []


def test_words_are_encoded_once():
    words = alignment.PieceSide(P.path("piece_bpe_32k.model"))
    assert alignment.word_by_word(words.model)
    sent, encode = [], words.encode.encode
    words.encode.encode = lambda found: sent.extend(found) or encode(found)
    texts = ["the tree  and the\ttree ", "", " ", "   x", "a\u2581b <s> \x00 日本", "the tree  and", "y" * 200 + " the"]
    whole = words.model.encode(texts)
    ids, counts, *_ = words.tokens(texts)
    assert counts.tolist() == list(map(len, whole)) and ids.tolist() == [i for t in whole for i in t]
    assert sent.count(" tree") == 1 and "  and" in sent


def test_groups_are_written_in_order():
    sides = [alignment.side(P.path(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    texts = ["Anblewh sttible of the", "", "x\u2581y", "1234567 unthinkable\n\n things "]
    found = alignment.Aligned(texts, *sides)
    for k, (text, got) in enumerate(zip(texts, found.written(), strict=True)):
        a0, a1, b0, b1 = found.spans[k]
        ends = list(zip(*found.bounds(k), strict=True))
        a, b = found.ids[0][a0:a1].tolist(), found.ids[1][b0:b1].tolist()
        said = [",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2]))
                for (i, j), (i2, j2) in zip([(0, 0), *ends], ends, strict=False)]
        assert got == ";".join(said) and bool(got) == (text in (texts[0], texts[3]))
