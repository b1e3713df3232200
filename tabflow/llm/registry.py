"""The queries of this package over the provided tables, with DuckDB SQL where SQL can say them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import (alignment, bpe, counts, fingerprints, jaccard, langid, mixing, periodic, secrets, sharding, topk,
                         transducer, wavelet)
from tabflow.llm.common import table
from tabflow.sources.io import run_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op2_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ')
        ELSE array_to_string(ws[i:i + 3], ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM w JOIN r ON r.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
""")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


@register("op3_mix_sources")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@register("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@register("op8_shard_documents")
def op8_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@register("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_path(spark, "token-files")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path,
                         public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return wavelet.read_documents(spark, path)


@register("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a new cache for each call, so that every call encodes every distinct text
    return counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               run_path(spark, "token-counts"))


@register("op6_byte_pairs")
def op6_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@register("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


@register("op10_top_k", """
WITH v AS (SELECT row_number() OVER () AS nth, vec_id, [floor(64 * e::DOUBLE) FOR e IN embedding] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e::DOUBLE)]) = 0),
s AS (SELECT q.nth, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.nth <> c.nth WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY nth ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 20
""")
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(20)) == 0), k=20, scale=64.0)


@register("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def with_period(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a tenth of the documents, chosen by id, repeated with a period from some word on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(periodic.find_runs(table(spark, sf_dir, "documents"), edit=with_period))


@register("op13_lexicon_bpe")
def op13_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
