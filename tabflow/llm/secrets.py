"""Secret scans through a trigram inverted index.

Each rule is a regular expression. A Boolean query over trigrams that every match must contain is
derived from its syntax; the index lists, per trigram and block of documents, the documents that
contain it (in lower case). Queries intersect and unite these lists; only the candidates they leave
are searched with the rule. A rule without a mandatory trigram is run over every text. Spans are
counted in code points: a text is split at the matches, so lengths of pieces and matches give places.

Defined results: a null text is empty and has no span; repeated rows are scanned one by one; an empty
table gives an empty result; texts of any length are scanned whole; columns of the input are kept
(``_spans`` is added, a clashing one is replaced).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import free_name, text_of
from tabflow.sources.io import materialize

#: Documents to a block of the index, about; what bounds a posting list.
BLOCK = 4096
#: A syntax tree's alternatives that are spelled out; beyond, a part gives no trigrams.
_MOST = 64
#: Code points of the chunks in which a text is cut for masking.
CHUNK = 1024
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost, non-overlapping; a match counts if its ``group`` has ``least``
    characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False


# The three base rules (their patterns and lengths), as the contract gives them.
# The runs of the second and third are greedy, so their least lengths are part of the pattern.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + EXTRA


# -- Boolean trigram queries: True, a trigram, ("and", parts) or ("or", parts) --------------------


def _spelled(op, arg) -> set[str] | None:
    """All strings that a node can match, if they are few."""
    if op is K.LITERAL:
        return {chr(arg).lower()}
    if op is K.IN and all(o is K.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(v).lower() for _, v in arg}
    if op is K.SUBPATTERN:
        return _spelled_all(arg[-1])
    if op is K.BRANCH:
        parts = [_spelled_all(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is K.MAX_REPEAT and arg[0] == 0 and arg[1] == 1:
        inner = _spelled_all(arg[2])
        return None if inner is None else inner | {""}
    return None


def _spelled_all(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        part = _spelled(op, arg)
        if part is None or len(out) * len(part) > _MOST:
            return None
        out = {a + b for a in out for b in part}
    return out


def _both(parts: list):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _either(parts: list):
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[str]):
    """Every match contains one of the strings."""
    needs = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    # what asks for more than another alternative adds nothing
    needs = [n for n in needs if not any(m < n for m in needs)]
    return _either([_both(sorted(n)) for n in sorted(needs, key=sorted)])


def _of_nodes(nodes):
    found, run = [], {""}
    for op, arg in nodes:
        part = _spelled(op, arg)
        if part is not None and len(run) * len(part) <= _MOST:
            run = {a + b for a in run for b in part}
            continue
        found.append(_of_strings(run))
        run = part if part is not None else {""}
        if part is None and op is K.SUBPATTERN:
            found.append(_of_nodes(arg[-1]))
        elif part is None and op is K.BRANCH:
            found.append(_either([_of_nodes(x) for x in arg[1]]))
        elif part is None and op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] > 0:
            found.append(_of_nodes(arg[2]))
    return _both([*found, _of_strings(run)])


def trigram_query(pattern: str):
    """The query that every text with a match of ``pattern`` satisfies, over its lower-case trigrams."""
    return _of_nodes(_parser.parse(pattern, re.ASCII))


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _answer(query, lists: Column) -> Column:
    """The documents of a block that satisfy a query, from its lists per trigram."""
    if isinstance(query, str):
        return F.coalesce(F.element_at(lists, F.lit(query)), F.array().cast("array<bigint>"))
    fold = F.array_intersect if query[0] == "and" else F.array_union
    return reduce(fold, [_answer(q, lists) for q in query[1]])


# -- scanning ------------------------------------------------------------------------------------


def build_index(texts: DataFrame, wanted: list[str], blocks: int) -> DataFrame:
    """(block, trigram, documents) from (doc, text): posting lists of the trigrams that rules ask
    for, cut into blocks, so that a trigram that every document has is no long list."""
    low = F.lower("text")
    has = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted]))
    return (texts.select("doc", F.pmod("doc", F.lit(blocks)).alias("block"), F.explode(has).alias("trigram"))
            .groupBy("block", "trigram").agg(F.collect_set("doc").alias("documents")))


def candidates(index: DataFrame, queries: dict) -> DataFrame:
    """(doc, rules): what the rules' queries leave."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "documents"))).alias("_l"))
    found = F.array(*[F.struct(F.lit(kind).alias("kind"), _answer(q, F.col("_l")).alias("documents"))
                      for kind, q in queries.items()])
    return (lists.select(F.explode(found).alias("_f"))
            .select("_f.kind", F.explode("_f.documents").alias("doc"))
            .groupBy("doc").agg(F.collect_set("kind").alias("rules")))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, fold) -> Column:
    """An array's running results of an associative ``fold`` (its first element, its first two, ...),
    by doubling: each round folds in the element twice as far back, so n elements take n log n steps."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def double(acc: Column, k: Column) -> Column:
        far = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= far, fold(F.get(acc, i - far), x)).otherwise(x))

    return F.aggregate(rounds, values, double)


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of one rule in a text, in about linear time however many there are."""
    pattern = F.lit(("(?i)" if rule.any_case else "") + rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    columns = [F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(whole, F.length).alias("whole")]
    if rule.group:
        columns.append(F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("part"))
    # the last gap has no match behind it
    steps = F.filter(F.arrays_zip(*columns), lambda x: x["whole"].isNotNull())

    def spans(steps: Column) -> Column:
        ends = _running(F.transform(steps, lambda x: x["gap"] + x["whole"]), lambda a, b: a + b)
        found = F.arrays_zip(steps.alias("step"), ends.alias("end"))
        kept = F.filter(found, lambda x: x["step"]["part" if rule.group else "whole"] >= rule.least)
        return F.transform(kept, lambda x: F.struct(
            (x["end"] - x["step"]["whole"]).alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
            F.lit(rule.kind).alias("kind"))).cast(_SPANS)

    return _bind(steps, spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``_spans``: (start, rank, end, kind) of all rules' matches, by start, then rule."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "_spans"])
    doc, found = free_name(docs, "_doc"), free_name(docs, "_rules")
    text = text_of(text_col)
    # rows are known by a hash: should two share it, both are candidates, and verification tells
    keyed = docs.withColumn(doc, F.xxhash64(F.col(id_col), F.col(text_col)))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if q is not True}
    wanted = sorted(set().union(*map(trigrams, indexed.values()))) if indexed else []
    if wanted:
        index = materialize(build_index(keyed.select(F.col(doc).alias("doc"), text.alias("text")), wanted,
                                        max(1, -(-docs.count() // BLOCK))), "secret-index")
        # written first, so that the join is planned with its size
        asked = materialize(candidates(index, indexed), "secret-candidates")
        keyed = keyed.join(asked.select(F.col("doc").alias(doc), F.col("rules").alias(found)), doc, "left")
    else:
        keyed = keyed.withColumn(found, F.lit(None).cast("array<string>"))
    none = F.array().cast(_SPANS)
    spans = []
    for rank, rule in enumerate(rules):
        run = (F.coalesce(F.array_contains(found, rule.kind), F.lit(False)) if rule.kind in indexed
               else text.rlike(("(?i)" if rule.any_case else "") + rule.pattern))
        spans.append(F.when(run, _matches(text, rule, rank)).otherwise(none))
    return keyed.withColumn("_spans", F.sort_array(F.concat(*spans))).select(*docs.columns, "_spans")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) from the result of ``scan``."""
    spans = F.col("_spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))

    def number(rule: Rule) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == rule.kind)).cast("bigint").alias(f"n_{rule.kind}")

    counts = [number(r) for r in BASE]
    return scanned.select(F.col(id_col), *counts, F.sha2(spans_text(base), 256).alias("base_sha256"),
                          spans_text(spans).alias("spans"))


def _piece(chunks: Column, begin: Column, end: Column) -> Column:
    """Code points ``begin`` to ``end`` of a text that is given in chunks, reading only their chunks."""
    first, last = (F.floor(x / CHUNK).cast("int") for x in (begin, F.greatest(end - 1, begin)))
    near = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
    return F.when(begin >= end, F.lit("")).otherwise(F.substring(near, begin - first * CHUNK + 1, end - begin))


def _masked(text: Column, spans: Column, by: str) -> Column:
    """``text`` with its sorted ``spans`` replaced, in about linear time however many there are."""
    # where the text goes on behind each span: the furthest end so far
    reach = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def joined(c: Column) -> Column:
        def before(s: Column, i: Column) -> Column:
            at = F.when(i > 0, F.get(c["reach"], i - 1)).otherwise(F.lit(0))
            return F.when(s["start"] >= at, F.concat(_piece(c["chunks"], at, s["start"]), F.lit(by))).otherwise(F.lit(""))

        rest = _piece(c["chunks"], F.element_at(c["reach"], -1), c["length"])
        return F.concat(F.array_join(F.transform(c["spans"], before), ""), rest)

    return _bind(F.struct(spans.alias("spans"), reach.alias("reach"), chunks.alias("chunks"), F.length(text).alias("length")), joined)


def mask(scanned: DataFrame, text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """The documents with every span of their texts (overlapping ones joined) replaced by ``by``."""
    text, spans = F.col(text_col), F.col("_spans")
    return scanned.withColumn(text_col, F.when(F.size(spans) > 0, _masked(text, spans, by)).otherwise(text)).drop("_spans")
