"""From raw documents to token ids: five stages, each on all rows that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import bpe, jaccard, langid, mixing, secrets
from tabflow.llm.common import free_name, table
from tabflow.sources.io import run_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (null, or without any letter) go; the others stay, and
    where ``lang`` is null it becomes the predicted language. Without labelled rows there is no model:
    a letter suffices, and ``lang`` stays null. Repeated rows are kept one by one; no rows give none."""
    model = langid.fit(docs, ~langid.held_out())
    if model is None:
        return langid.with_letter(docs)
    known = langid.predict(docs, model).filter(F.col("lang_pred") != langid.UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.8 or more of the runs of five words in common) the
    document with the smallest id stays. ``op2_jaccard_join`` has its own, stricter rule."""
    return jaccard.keep_one(docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; ``n_chars`` counts the new text."""
    masked = secrets.mask(secrets.scan(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    copy = free_name(docs, "_copy")
    mixed = mixing.mix(docs).filter("copies > 0")
    return mixed.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), keep_ids=True)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("byte_pairs", byte_pairs)]

#: A fitted classifier and BPE have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = run_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
