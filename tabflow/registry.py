"""Registered queries over the provided tables, each with its DuckDB oracle where SQL can say it.

Every query reads whole tables (no id subsets, no row caps); limits appear only where the
operator is a top-k. Doubles are rounded and counts are BIGINT in both engines so an exact
value hash can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.sources import io
from tabflow.sources.io import materialize, read_table, run_path
from tabflow.operators import clean as C
from tabflow.operators import harmonize as H
from tabflow.spec import FeatureSpec, SourceSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------------------------
# Harmonise + union (P1-P5, P9, U1, F2): customer and supplier into one account table.

ACCOUNT_SPEC = FeatureSpec(numeric=("acctbal",), categorical=("segment", "nationkey"),
                           target="label", lineage="source", key=("id",))
CUSTOMER_SRC = SourceSpec(name="customer", rename={"c_custkey": "id", "c_nationkey": "nationkey",
                                                   "c_acctbal": "acctbal", "c_mktsegment": "segment"})
SUPPLIER_SRC = SourceSpec(name="supplier", rename={"s_suppkey": "id", "s_nationkey": "nationkey",
                                                   "s_acctbal": "acctbal"})
NATION_SRC = SourceSpec(name="nation", rename={"n_nationkey": "id", "n_regionkey": "nationkey"},
                        add={"acctbal": 0.0, "segment": "NATION"})


def accounts(spark: SparkSession, sf_dir: str, with_nation: bool = False) -> DataFrame:
    sources = [(table(spark, sf_dir, "customer"), CUSTOMER_SRC),
               (table(spark, sf_dir, "supplier"), SUPPLIER_SRC)]
    if with_nation:
        sources.append((table(spark, sf_dir, "nation"), NATION_SRC))
    df = H.combine(sources, ACCOUNT_SPEC)
    return C.clean_categorical(C.coerce_numeric(df, ["acctbal"]), ["segment", "nationkey"])


@register("harmonize_union", """
SELECT source, segment, CAST(count(*) AS BIGINT) AS n, round(avg(acctbal), 4) AS avg_bal
FROM (SELECT c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS source FROM customer
      UNION ALL
      SELECT s_acctbal, 'missing', 'supplier' FROM supplier)
GROUP BY source, segment
""")
def q_harmonize_union(spark, sf_dir):
    df = accounts(spark, sf_dir)
    return (df.groupBy("source", "segment")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.round(F.avg("acctbal"), 4).alias("avg_bal")))


@register("combine_three_sources", """
SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT segment) AS BIGINT) AS n_segments,
       round(sum(acctbal), 2) AS sum_bal
FROM (SELECT c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS source FROM customer
      UNION ALL SELECT s_acctbal, 'missing', 'supplier' FROM supplier
      UNION ALL SELECT 0.0, 'NATION', 'nation' FROM nation)
GROUP BY source
""")
def q_combine_three(spark, sf_dir):
    """N-way fold of three sources through one harmonise + union."""
    df = accounts(spark, sf_dir, with_nation=True)
    return (df.groupBy("source")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.countDistinct("segment").cast("bigint").alias("n_segments"),
                 F.round(F.sum("acctbal"), 2).alias("sum_bal")))


@register("harmonize_rows", """
SELECT id, source, nationkey, round(acctbal, 2) AS acctbal, segment FROM (
  SELECT c_custkey AS id, 'customer' AS source, CAST(c_nationkey AS VARCHAR) AS nationkey,
         c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
  UNION ALL
  SELECT s_suppkey, 'supplier', CAST(s_nationkey AS VARCHAR), s_acctbal, 'missing' FROM supplier)
""")
def q_harmonize_rows(spark, sf_dir):
    """P1-P5, P7, U1 row by row: every harmonised row, aligned columns in spec order."""
    df = accounts(spark, sf_dir)
    return df.select("id", "source", "nationkey", F.round("acctbal", 2).alias("acctbal"), "segment")


@register("recode_lookup", """
SELECT CASE WHEN TRY_CAST(n_regionkey AS DOUBLE) = 0 THEN 'AFR' WHEN n_regionkey = 1 THEN 'AME'
            WHEN n_regionkey = 2 THEN 'ASI' ELSE NULL END AS region_code,
       CAST(count(*) AS BIGINT) AS n
FROM nation GROUP BY 1
""")
def q_recode_lookup(spark, sf_dir):
    """Recode by dictionary; unmapped values become NULL."""
    df = H.recode(table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "region_code"),
                  "region_code", {0: "AFR", 1: "AME", 2: "ASI"})
    return df.groupBy("region_code").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# Above the CASE limit: a dictionary over every value of p_size (1 to 50 at any scale).
_SIZE_CLASSES = {k: f"class{k % 13}" for k in range(1, 51)}


@register("recode_join", """
SELECT 'class' || CAST(p_size % 13 AS VARCHAR) AS size_class,
       CAST(count(*) AS BIGINT) AS n, round(sum(p_retailprice), 2) AS sum_price
FROM part GROUP BY 1
""")
def q_recode_join(spark, sf_dir):
    """A dictionary above the CASE limit becomes a left lookup join."""
    df = table(spark, sf_dir, "part").withColumn("size_class", F.col("p_size"))
    df = H.recode(df, "size_class", _SIZE_CLASSES)
    return df.groupBy("size_class").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                        F.round(F.sum("p_retailprice"), 2).alias("sum_price"))


@register("recode_large_duplicates", """
SELECT p_partkey, CASE WHEN p_size <> 50 THEN 'class' || CAST(p_size % 13 AS VARCHAR) END AS size_class FROM part
""")
def q_recode_large_duplicates(spark, sf_dir):
    """Keys that are the same number (7, '7', '7.0') are one key, the first counts, and no row of
    the recoded table is multiplied; a value without a key becomes NULL."""
    mapping = {k: v for k, v in _SIZE_CLASSES.items() if k != 50}
    mapping |= {str(k): "again" for k in mapping} | {f"{k}.0": "and again" for k in mapping}
    df = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("size_class"))
    return H.recode(df, "size_class", mapping)


_NUM_GUARD = r"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


@register("coerce_numeric", f"""
WITH raw AS (SELECT p_partkey,
  CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS size_text FROM part)
SELECT p_partkey,
  CASE WHEN regexp_matches(trim(size_text), {_NUM_GUARD}) THEN TRY_CAST(trim(size_text) AS DOUBLE) END
    AS size_num
FROM raw
""")
def q_coerce_numeric(spark, sf_dir):
    """Text in a numeric column → NULL, numbers → double."""
    p = table(spark, sf_dir, "part")
    raw = p.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, F.col("p_name"))
                   .otherwise(F.col("p_size").cast("string")).alias("size_num"))
    return C.coerce_numeric(raw, ["size_num"])


def documents_labelled(spark, sf_dir) -> DataFrame:
    """documents left join labels: unlabelled documents carry a NULL target."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


@register("clean_target", """
SELECT doc_id, lang,
       CAST(CAST(trunc(quality * 0.5 + toxic * 1.5) AS BIGINT) > 0 AS INTEGER) AS target
FROM documents JOIN labels USING (doc_id)
""")
def q_clean_target(spark, sf_dir):
    """F1 + P10: drop rows with no target, binarise (truncate, then > 0: 0.5 → 0, 1.5 → 1)."""
    df = documents_labelled(spark, sf_dir).withColumn(
        "target", F.col("quality") * 0.5 + F.col("toxic") * 1.5)
    out = C.binarize(C.drop_null_target(df, "target"), "target")
    return out.select("doc_id", "lang", "target")


@register("dropped_counts", """
SELECT source, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(quality) AS BIGINT) AS n_kept,
       CAST(count(*) - count(quality) AS BIGINT) AS n_dropped
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source
""")
def q_dropped_counts(spark, sf_dir):
    """rows dropped for a missing target, per source, in one aggregate."""
    return C.dropped_counts(documents_labelled(spark, sf_dir), "quality", by="source")


@register("clean_categorical", """
SELECT doc_id, CASE WHEN quality IS NULL THEN 'missing' ELSE CAST(quality AS VARCHAR) END AS quality,
       coalesce(CASE WHEN toxic = 1 THEN lang END, 'missing') AS lang
FROM documents LEFT JOIN labels USING (doc_id)
""")
def q_clean_categorical(spark, sf_dir):
    """P7/FE3: categories to canonical text, missing → 'missing'."""
    df = documents_labelled(spark, sf_dir).select(
        "doc_id", "quality", F.when(F.col("toxic") == 1, F.col("lang")).alias("lang"))
    return C.clean_categorical(df, ["quality", "lang"])


@register("clean_categorical_codes", """
SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code,
       '1234567890' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS long_code, CAST(p_size AS VARCHAR) || 'e3' AS power,
       CASE WHEN p_size % 5 = 0 THEN 'missing' ELSE CAST(p_size AS VARCHAR) END AS size
FROM part
""")
def q_clean_categorical_codes(spark, sf_dir):
    """Text categories keep zero padding, all digits and signs; numbers come out canonical."""
    p = table(spark, sf_dir, "part")
    code = F.lpad(F.col("p_partkey").cast("string"), 8, "0")
    df = p.select("p_partkey", code.alias("code"), F.concat(F.lit("1234567890"), code).alias("long_code"),
                  F.concat(F.col("p_size").cast("string"), F.lit("e3")).alias("power"),
                  F.when(F.col("p_size") % 5 != 0, F.col("p_size").cast("double")).alias("size"))
    return C.clean_categorical(df, ["code", "long_code", "power", "size"])


_EXTREME_SQL = """CASE o_orderkey % 5 WHEN 0 THEN o_totalprice * 1e25 WHEN 1 THEN 0.5 WHEN 2 THEN -1e30 WHEN 3 THEN 1.0
                  END"""


@register("binarize_extremes", f"""
SELECT o_orderkey, CAST(({_EXTREME_SQL}) >= 1 AS INTEGER) AS target FROM orders
""")
def q_binarize_extremes(spark, sf_dir):
    """P10: a target beyond 64 bits, below 1, negative, 1 and missing."""
    k = F.col("o_orderkey") % 5
    x = (F.when(k == 0, F.col("o_totalprice").cast("double") * 1e25).when(k == 1, F.lit(0.5))
         .when(k == 2, F.lit(-1e30)).when(k == 3, F.lit(1.0)))
    return C.binarize(table(spark, sf_dir, "orders").select("o_orderkey", x.alias("target")), "target")


@register("fill_const", """
SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS quality, CAST(coalesce(toxic, 0) AS DOUBLE) AS toxic
FROM documents LEFT JOIN labels USING (doc_id)
""")
def q_fill_const(spark, sf_dir):
    """P9 (binary role): parse to number, missing → 0."""
    df = C.coerce_numeric(documents_labelled(spark, sf_dir), ["quality", "toxic"])
    return C.fill_const(df, {"quality": 0.0, "toxic": 0.0}).select("doc_id", "quality", "toxic")


# ---------------------------------------------------------------------------------------------
# Profiling (A1-A11, F3) over lineitem numerics with holes made by expression.

from tabflow.operators import profile as P  # noqa: E402

LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "linenumber")
_LINE_SQL = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax,
        CAST(nullif(l_linenumber, 7) AS DOUBLE) AS linenumber,
        nullif(l_returnflag, 'R') AS returnflag, l_linestatus FROM lineitem)"""
_LINE_LONG = f"""(UNPIVOT {_LINE_SQL} ON l_quantity, l_extendedprice, l_discount, l_tax, linenumber
        INTO NAME column_name VALUE value)"""


def lineitem_holes(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     F.nullif(F.col("l_linenumber"), F.lit(7)).cast("double").alias("linenumber"),
                     F.nullif(F.col("l_returnflag"), F.lit("R")).alias("returnflag"), "l_linestatus")


def _r6(df, cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register("describe_exact", f"""
SELECT column_name, CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM {_LINE_LONG} GROUP BY column_name
""")
def q_describe_exact(spark, sf_dir):
    """A1: exact describe of five numeric columns (one with holes)."""
    d = P.describe_exact(lineitem_holes(spark, sf_dir), LINE_NUMERIC)
    return _r6(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register("describe_approx")
def q_describe_approx(spark, sf_dir):
    """A2: sketch describe (rank error ≤ n/accuracy); rows-only, checked by a unit test."""
    return P.describe_approx(lineitem_holes(spark, sf_dir), LINE_NUMERIC)


@register("null_counts", f"""
SELECT column_name, CAST(n_null AS BIGINT) AS n_null FROM (
  UNPIVOT (SELECT count_if(l_quantity IS NULL) AS l_quantity, count_if(linenumber IS NULL) AS linenumber,
                  count_if(returnflag IS NULL) AS returnflag, count_if(l_linestatus IS NULL) AS l_linestatus
           FROM {_LINE_SQL})
  ON l_quantity, linenumber, returnflag, l_linestatus INTO NAME column_name VALUE n_null)
""")
def q_null_counts(spark, sf_dir):
    """A3: missing count per column, one aggregate."""
    return P.null_counts(lineitem_holes(spark, sf_dir),
                         ["l_quantity", "linenumber", "returnflag", "l_linestatus"]) \
        .withColumn("n_null", F.col("n_null").cast("bigint"))


@register("columns_with_nulls", f"""
SELECT column_name, CAST(n_null AS BIGINT) AS n_null FROM (
  UNPIVOT (SELECT count_if(l_quantity IS NULL) AS l_quantity, count_if(linenumber IS NULL) AS linenumber,
                  count_if(returnflag IS NULL) AS returnflag, count_if(l_linestatus IS NULL) AS l_linestatus
           FROM {_LINE_SQL})
  ON l_quantity, linenumber, returnflag, l_linestatus INTO NAME column_name VALUE n_null)
WHERE n_null > 0
""")
def q_columns_with_nulls(spark, sf_dir):
    """the null report filtered to columns that have missing values."""
    return P.columns_with_nulls(lineitem_holes(spark, sf_dir),
                                ["l_quantity", "linenumber", "returnflag", "l_linestatus"]) \
        .withColumn("n_null", F.col("n_null").cast("bigint"))


@register("total_nulls", f"""
SELECT CAST(count_if(linenumber IS NULL) + count_if(returnflag IS NULL) + count_if(l_tax IS NULL)
       AS BIGINT) AS n_null_total FROM {_LINE_SQL}
""")
def q_total_nulls(spark, sf_dir):
    """A4: total missing cells before preprocessing."""
    return P.total_nulls(lineitem_holes(spark, sf_dir), ["linenumber", "returnflag", "l_tax"])


@register("value_counts", """
SELECT quality, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS ratio
FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY quality
""")
def q_value_counts(spark, sf_dir):
    """A5: target distribution, counts and shares."""
    v = P.value_counts(documents_labelled(spark, sf_dir), "quality")
    return v.select("quality", F.col("n").cast("bigint").alias("n"), F.round("ratio", 6).alias("ratio"))


@register("category_counts", """
SELECT column_name, value, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'lang' AS column_name, lang AS value FROM documents
  UNION ALL SELECT 'source', source FROM documents)
GROUP BY column_name, value
""")
def q_category_counts(spark, sf_dir):
    """Counts of every category of every categorical column, one aggregate."""
    d = table(spark, sf_dir, "documents")
    return P.category_counts(d, ["lang", "source"]).withColumn("n", F.col("n").cast("bigint"))


@register("histogram", f"""
WITH l AS {_LINE_LONG},
r AS (SELECT column_name, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
             CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
      FROM l GROUP BY column_name)
SELECT g.column_name, CAST(g.bin AS INTEGER) AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 15), 6) AS lo,
       round(lo + g.bin * ((hi - lo) / 15), 6) AS hi, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT column_name, lo, hi, unnest(range(1, 16)) AS bin FROM r) g
LEFT JOIN (SELECT column_name, least(floor((value - lo) / (hi - lo) * 15) + 1, 15) AS bin, count(*) AS n
           FROM l JOIN r USING (column_name) GROUP BY ALL) c ON c.column_name = g.column_name AND c.bin = g.bin
""")
def q_histogram(spark, sf_dir):
    """15 equal-width bins per numeric column, last bin closed, empty bins included."""
    h = P.histogram(lineitem_holes(spark, sf_dir), LINE_NUMERIC, bins=15)
    return _r6(h, ["lo", "hi"]).withColumn("n", F.col("n").cast("bigint"))


@register("schema_info", f"""
SELECT column_name, CASE dt WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                    WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' END AS type,
       CAST(non_null AS BIGINT) AS non_null
FROM (UNPIVOT (SELECT any_value(typeof(l_quantity)) AS l_quantity, any_value(typeof(l_extendedprice)) AS l_extendedprice, any_value(typeof(l_discount)) AS l_discount, any_value(typeof(l_tax)) AS l_tax, any_value(typeof(linenumber)) AS linenumber, any_value(typeof(returnflag)) AS returnflag, any_value(typeof(l_linestatus)) AS l_linestatus FROM {_LINE_SQL}) ON COLUMNS(*) INTO NAME column_name VALUE dt)
JOIN (UNPIVOT (SELECT count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice, count(l_discount) AS l_discount, count(l_tax) AS l_tax, count(linenumber) AS linenumber, count(returnflag) AS returnflag, count(l_linestatus) AS l_linestatus FROM {_LINE_SQL}) ON COLUMNS(*) INTO NAME column_name VALUE non_null)
USING (column_name)
""")
def q_schema_info(spark, sf_dir):
    """Column, type, non-missing count."""
    return P.schema_info(lineitem_holes(spark, sf_dir))


@register("row_count", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem")
def q_row_count(spark, sf_dir):
    """A9."""
    return P.row_count(table(spark, sf_dir, "lineitem")).withColumn("n_rows", F.col("n_rows").cast("bigint"))


@register("head_n", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 10
""")
def q_head_n(spark, sf_dir):
    """A10: the first rows by key (a top-k: the limit is the feature)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))
    return P.head_n(o, 10, "o_orderkey")


# ---------------------------------------------------------------------------------------------
# Splits, folds, samples (SP1-SP3, T3). Oracle: a plain per-class window over the same hash.

from tabflow.operators import split as SP  # noqa: E402


def _hash_sql(key: str, seed: int) -> str:
    return f"('0x' || substr(md5(concat(CAST({key} AS VARCHAR), ':', '{seed}')), 1, 8))::BIGINT"


@register("stratified_split", f"""
SELECT doc_id, quality, CASE WHEN rn <= floor(0.2 * n_class + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT doc_id, quality,
             row_number() OVER (PARTITION BY quality ORDER BY {_hash_sql('doc_id', 42)}, doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS n_class
      FROM labels JOIN documents USING (doc_id))
""")
def q_stratified_split(spark, sf_dir):
    """SP1: stratified 80/20 split of the labelled documents, seed 42."""
    df = documents_labelled(spark, sf_dir).filter(F.col("quality").isNotNull())
    return SP.stratified_split(df, "quality", 0.2, 42, "doc_id").select("doc_id", "quality", "split")


@register("stratified_folds", f"""
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus
              ORDER BY {_hash_sql('o_orderkey', 42)}, o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders
""")
def q_stratified_folds(spark, sf_dir):
    """SP2/SP3: 5 stratified, hash-shuffled folds over all orders (3 classes, one dominant)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return SP.stratified_folds(o, "o_orderstatus", 5, 42, "o_orderkey")


@register("fold_balance", f"""
SELECT o_orderstatus, fold, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT o_orderstatus, (row_number() OVER (PARTITION BY o_orderstatus
              ORDER BY {_hash_sql('o_orderkey', 7)}, o_orderkey) - 1) % 10 AS fold FROM orders)
GROUP BY ALL
""")
def q_fold_balance(spark, sf_dir):
    """SP3 with 10 folds and another seed: per fold and class sizes (differ by at most one)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    f = SP.stratified_folds(o, "o_orderstatus", 10, 7, "o_orderkey")
    return f.groupBy("o_orderstatus", F.col("fold").cast("bigint").alias("fold")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("split_duplicate_keys", f"""
SELECT l_linestatus, l_orderkey, fold, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT l_linestatus, l_orderkey, CAST((dense_rank() OVER (PARTITION BY l_linestatus
         ORDER BY {_hash_sql('l_orderkey', 42)}, l_orderkey) - 1) % 5 AS INTEGER) AS fold FROM lineitem)
GROUP BY ALL
""")
def q_split_duplicate_keys(spark, sf_dir):
    """SP2: rows that share a key (an order's lines) are never parted into different folds."""
    li = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_orderkey")
    f = SP.stratified_folds(li, "l_linestatus", 5, 42, "l_orderkey")
    return f.groupBy("l_linestatus", "l_orderkey", "fold").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("sample_n", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       round(l_extendedprice, 2) AS l_extendedprice FROM lineitem
ORDER BY ('0x' || substr(md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber,
          CAST(l_quantity AS BIGINT), '42')), 1, 8))::BIGINT, l_orderkey, l_partkey, l_suppkey,
         l_linenumber, l_quantity
LIMIT 1000
""")
def q_sample_n(spark, sf_dir):
    """Repeatable 1000-row sample by key hash (the limit is the operator)."""
    li = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, F.round("l_extendedprice", 2).alias("l_extendedprice"))
    keyed = li.withColumn("_qty", F.col("l_quantity").cast("bigint"))
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "_qty"]
    return SP.sample_n(keyed, 1000, 42, key).drop("_qty")


# ---------------------------------------------------------------------------------------------
# Evaluation (E1-E7, J2, J3, A11, T1, T2) over deterministic scores with many ties.

from tabflow.plans import metrics as M  # noqa: E402

SCORE_MODELS = ("disc", "tax", "qty")
_LINE_KEY_SQL = ("concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, "
                 "CAST(l_quantity AS BIGINT))")
_SCORES_SQL = f"""(SELECT row_id, label, model, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (
  SELECT {_LINE_KEY_SQL} AS row_id, CAST(l_returnflag = 'R' AS INTEGER) AS label,
         'disc' AS model, l_discount * 10 AS score FROM lineitem
  UNION ALL SELECT {_LINE_KEY_SQL}, CAST(l_returnflag = 'R' AS INTEGER), 'tax',
         l_tax * 12.5 FROM lineitem
  UNION ALL SELECT {_LINE_KEY_SQL}, CAST(l_returnflag = 'R' AS INTEGER), 'qty',
         l_quantity / 50 FROM lineitem))"""


# lineitem has no single-column key; these five columns are unique at every scale factor.
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


def line_key():
    return F.concat_ws("-", *[F.col(c).cast("bigint").cast("string") for c in LINE_KEY])


def lineitem_scores(spark, sf_dir) -> DataFrame:
    """Long score table from one scan: three score expressions unpivoted."""
    li = table(spark, sf_dir, "lineitem").select(
        line_key().alias("row_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_discount") * 10).alias("disc"), (F.col("l_tax") * 12.5).alias("tax"),
        (F.col("l_quantity") / 50).alias("qty"))
    long = li.unpivot(["row_id", "label"], list(SCORE_MODELS), "model", "score")
    return long.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


@register("confusion_matrix", f"""
WITH s AS (SELECT * FROM {_SCORES_SQL})
SELECT g.model, g.label, g.prediction, CAST(count(s.row_id) AS BIGINT) AS n
FROM (SELECT model, unnest([0, 0, 1, 1]) AS label, unnest([0, 1, 0, 1]) AS prediction
      FROM (SELECT DISTINCT model FROM s)) g
LEFT JOIN s ON s.model = g.model AND s.label = g.label AND s.prediction = g.prediction GROUP BY ALL
""")
def q_confusion_matrix(spark, sf_dir):
    """The full 2×2 grid per model, zeros included."""
    return M.confusion_matrix(lineitem_scores(spark, sf_dir)).withColumn("n", F.col("n").cast("bigint"))


_CC_SQL = f"""(SELECT model, count_if(label=0 AND prediction=0) AS tn, count_if(label=0 AND prediction=1) AS fp,
        count_if(label=1 AND prediction=0) AS fn, count_if(label=1 AND prediction=1) AS tp
      FROM {_SCORES_SQL} GROUP BY model)"""


def _sdiv(a, b):
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END)"


_P1, _R1 = _sdiv("tp", "tp + fp"), _sdiv("tp", "tp + fn")
_P0, _R0 = _sdiv("tn", "tn + fn"), _sdiv("tn", "tn + fp")
_F1, _F0 = _sdiv(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}"), _sdiv(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")


@register("binary_metrics", f"""
SELECT model, round({_sdiv('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy, round({_P1}, 6) AS precision,
       round({_R1}, 6) AS recall, round({_F1}, 6) AS f1
FROM {_CC_SQL}
""")
def q_binary_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1 per model."""
    b = M.binary_metrics(lineitem_scores(spark, sf_dir))
    return _r6(b, ["accuracy", "precision", "recall", "f1"])


_AUC_SQL = """WITH d AS (SELECT {g}, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg
                FROM {src} GROUP BY {g}, score),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {g} ORDER BY score
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM d)
SELECT {g}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                 THEN sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc
FROM c GROUP BY {g}"""


@register("roc_auc", f"""
SELECT model, round(roc_auc, 6) AS roc_auc FROM ({_AUC_SQL.format(g='model', src=_SCORES_SQL)})
""")
def q_roc_auc(spark, sf_dir):
    """Exact AUC with heavy ties (scores take few distinct values)."""
    return _r6(M.roc_auc(lineitem_scores(spark, sf_dir)), ["roc_auc"])


@register("roc_auc_fine_buckets", f"""
SELECT model, round(roc_auc, 6) AS roc_auc FROM ({_AUC_SQL.format(g='model', src=_SCORES_SQL)})
""")
def q_roc_auc_fine(spark, sf_dir):
    """E3 with only 4 range buckets, so every bucket holds many scores: the two-level prefix sum
    must still equal the single-window oracle."""
    return _r6(M.roc_auc(lineitem_scores(spark, sf_dir), n_buckets=4), ["roc_auc"])


_REPORT_SQL = f"""(SELECT model, 'class0' AS cls, {_P0} AS precision, {_R0} AS recall, {_F0} AS f1, tn + fp AS support FROM {_CC_SQL}
  UNION ALL SELECT model, 'class1', {_P1}, {_R1}, {_F1}, tp + fn FROM {_CC_SQL}
  UNION ALL SELECT model, 'macro_avg', ({_P0} + {_P1}) / 2, ({_R0} + {_R1}) / 2, ({_F0} + {_F1}) / 2,
                   tn + fp + tp + fn FROM {_CC_SQL}
  UNION ALL SELECT model, 'weighted_avg', {_sdiv(f'{_P0} * (tn + fp) + {_P1} * (tp + fn)', 'tn + fp + tp + fn')},
                   {_sdiv(f'{_R0} * (tn + fp) + {_R1} * (tp + fn)', 'tn + fp + tp + fn')},
                   {_sdiv(f'{_F0} * (tn + fp) + {_F1} * (tp + fn)', 'tn + fp + tp + fn')},
                   tn + fp + tp + fn FROM {_CC_SQL})"""


@register("class_report", f"""
SELECT model, cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM {_REPORT_SQL}
""")
def q_class_report(spark, sf_dir):
    """E5: per-class report with macro and weighted averages."""
    return _r6(M.class_report(lineitem_scores(spark, sf_dir)), ["precision", "recall", "f1"])


_FLAT_COLS = [f"{mo}_{me}_{c}" for mo in SCORE_MODELS for me in M.REPORT_METRICS for c in M.REPORT_CLASSES]


@register("flatten_report", "SELECT " + ", ".join(
    f"round(max(CASE WHEN model = '{c.split('_')[0]}' AND cls = '{c.split('_', 2)[2]}' THEN "
    f"{c.split('_')[1]} END), 6) AS {c}" for c in _FLAT_COLS) + f" FROM {_REPORT_SQL}")
def q_flatten_report(spark, sf_dir):
    """The report flattened to `{model}_{metric}_{class}` columns, one row."""
    flat = M.flatten_report(M.class_report(lineitem_scores(spark, sf_dir)), models=SCORE_MODELS)
    return _r6(flat, _FLAT_COLS)


@register("evaluate_models", f"""
SELECT m.model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(a.roc_auc, 6) AS roc_auc
FROM (SELECT model, {_sdiv('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {_P1} AS precision, {_R1} AS recall,
             {_F1} AS f1 FROM {_CC_SQL}) m
LEFT JOIN ({_AUC_SQL.format(g='model', src=_SCORES_SQL)}) a USING (model)
""")
def q_evaluate_models(spark, sf_dir):
    """Several models compared in the same aggregates."""
    e = M.evaluate(lineitem_scores(spark, sf_dir))
    return _r6(e, ["accuracy", "precision", "recall", "f1", "roc_auc"])


@register("score_columns", """
SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
       round(o_totalprice / 611953, 6) AS price, round((o_custkey % 100) / 100.0, 6) AS cust
FROM orders
""")
def q_score_columns(spark, sf_dir):
    """Per-model score rows pivoted to one column per model, label carried along."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.round(F.col("o_totalprice") / 611953, 6).alias("price"),
        F.round((F.col("o_custkey") % 100) / 100.0, 6).alias("cust"))
    long = o.unpivot(["row_id", "label"], ["price", "cust"], "model", "score")
    return M.score_columns(long, ["price", "cust"])


@register("stack_input_two_sources", """
SELECT concat('{"source":"customer","id":', c_custkey, ',"_content":0}#1') AS row_id, CAST(c_acctbal > 0 AS INTEGER) AS label,
       round(c_acctbal / 10000, 6) AS bal, round(c_nationkey / 25.0, 6) AS nat FROM customer
UNION ALL SELECT concat('{"source":"supplier","id":', s_suppkey, ',"_content":0}#1'), CAST(s_acctbal > 0 AS INTEGER),
       round(s_acctbal / 10000, 6), round(s_nationkey / 25.0, 6) FROM supplier
""")
def q_stack_input_two_sources(spark, sf_dir):
    """Customers and suppliers share ids; every row that comes out is one that went in, with
    its own scores, under its identity (source, key, occurrence)."""
    from tabflow.plans.workflow import row_identity
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
                                                F.col("c_acctbal").alias("x"), F.col("c_nationkey").alias("y"))
    u = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"),
                                                F.col("s_acctbal").alias("x"), F.col("s_nationkey").alias("y"))
    spec = FeatureSpec(numeric=("x", "y"), categorical=(), binary=(), target="label", lineage="source", key=("id",))
    both = row_identity(c.unionByName(u), spec).select(
        "row_id", (F.col("x") > 0).cast("int").alias("label"),
        F.round(F.col("x") / 10000, 6).alias("bal"), F.round(F.col("y") / 25.0, 6).alias("nat"))
    return M.score_columns(both.unpivot(["row_id", "label"], ["bal", "nat"], "model", "score"), ["bal", "nat"])


@register("row_identity_hot_key", """
SELECT concat('{"source":"events","kind":"', CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END,
              '","_content":0}#', row_number() OVER (PARTITION BY CASE WHEN user_id % 3 = 0 THEN 'hot'
                ELSE CAST(user_id AS VARCHAR) END)) AS row_id FROM events
""")
def q_row_identity_hot_key(spark, sf_dir):
    """A key with a third of all rows, numbered by ranges: every occurrence once, none left out."""
    from tabflow.plans.workflow import row_identity
    e = table(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string"))
        .alias("kind"), F.substring("event_type", 1, 1).alias("first"))
    spec = FeatureSpec(numeric=(), categorical=("first",), binary=(), target="label", lineage="source", key=("kind",))
    return row_identity(e, spec, hot_rows=100).select("row_id")


_FOLD_SCORES_SQL = f"""(SELECT row_id, label, score, (row_number() OVER (PARTITION BY label
        ORDER BY {_hash_sql('row_id', 42)}, row_id) - 1) % 5 AS fold
      FROM {_SCORES_SQL} WHERE model = 'disc')"""


@register("cv_mean_std", f"""
SELECT round(avg(roc_auc), 6) AS mean, round(stddev_pop(roc_auc), 6) AS std
FROM ({_AUC_SQL.format(g='fold', src=_FOLD_SCORES_SQL)})
""")
def q_cv_mean_std(spark, sf_dir):
    """A11 (+SP2, E3): AUC per stratified fold, then mean and population std over folds."""
    s = lineitem_scores(spark, sf_dir).filter(F.col("model") == "disc")
    f = SP.stratified_folds(s, "label", 5, 42, "row_id")
    per_fold = M.roc_auc(f, model="fold")
    return _r6(P.mean_std(per_fold, "roc_auc"), ["mean", "std"])


@register("top_k", """
SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem
GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 10
""")
def q_top_k(spark, sf_dir):
    """Top 10 by value, ties by name (a TakeOrdered over the grouped table)."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey") \
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    return M.top_k(g, "revenue", 10, "l_partkey")


@register("top_k_abs", """
SELECT l_suppkey, round(sum(l_quantity * (l_discount - 0.05)), 6) + 0.0 AS effect FROM lineitem
GROUP BY l_suppkey ORDER BY abs(effect) DESC, l_suppkey LIMIT 15
""")
def q_top_k_abs(spark, sf_dir):
    """Top 15 by absolute value."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey") \
        .agg(F.round(F.sum(F.col("l_quantity") * (F.col("l_discount") - 0.05)), 6).alias("effect"))
    return M.top_k(g, "effect", 15, "l_suppkey", by_abs=True)


# ---------------------------------------------------------------------------------------------
# Features (FE1-FE6, FE8): fit on the train split of the labelled documents, apply to all.

from tabflow.plans import features as FE  # noqa: E402
from tabflow.plans import wide as WIDE  # noqa: E402

DOC_SPEC = FeatureSpec(numeric=("n_chars",), categorical=("lang", "source"), binary=("toxic",),
                       target="quality", lineage=None, key=("doc_id",))


def documents_features_input(spark, sf_dir) -> DataFrame:
    """Documents with holes in the numeric column (German documents) and a NULL binary for
    unlabelled ones."""
    d = documents_labelled(spark, sf_dir)
    return d.withColumn("n_chars", F.when(F.col("lang") != "de", F.col("n_chars")))


_DOC_SQL = """(SELECT doc_id, lang, source, CASE WHEN lang <> 'de' THEN n_chars END AS n_chars, toxic, quality
   FROM documents LEFT JOIN labels USING (doc_id))"""
_DOC_TRAIN_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quality
       ORDER BY {_hash_sql('doc_id', 42)}, doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS n_class
     FROM {_DOC_SQL} WHERE quality IS NOT NULL) WHERE rn > floor(0.2 * n_class + 0.5))"""


@register("features_onehot", f"""
WITH d AS {_DOC_SQL}, tr AS {_DOC_TRAIN_SQL},
st AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) * sqrt(count(n_chars) / count(*)) AS s FROM tr),
cats AS (SELECT DISTINCT 'lang' AS col, coalesce(lang, 'missing') AS v FROM tr
         UNION SELECT DISTINCT 'source', coalesce(source, 'missing') FROM tr),
slots AS (
  SELECT doc_id, 'n_chars' AS slot,
         coalesce((n_chars - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 0) AS value FROM d JOIN st ON TRUE
  UNION ALL SELECT doc_id, 'lang_' || coalesce(lang, 'missing'), 1.0 FROM d
            WHERE coalesce(lang, 'missing') IN (SELECT v FROM cats WHERE col = 'lang')
  UNION ALL SELECT doc_id, 'source_' || coalesce(source, 'missing'), 1.0 FROM d
            WHERE coalesce(source, 'missing') IN (SELECT v FROM cats WHERE col = 'source')
  UNION ALL SELECT doc_id, 'toxic', CAST(coalesce(toxic, 0) AS DOUBLE) FROM d)
SELECT doc_id, slot, round(value, 6) + 0.0 AS value FROM slots WHERE value <> 0
""")
def q_features_onehot(spark, sf_dir):
    """FE1-FE6, FE8: imputed + population-standardised numeric, alphabetical one-hot with unseen →
    zeros, binary pass-through; fitted on train rows only, applied to every document."""
    d = documents_features_input(spark, sf_dir)
    train = materialize(SP.stratified_split(d.filter(F.col("quality").isNotNull()), "quality", 0.2, 42, "doc_id")
                        .filter(F.col("split") == "train"), "doc-train-rows")
    model = FE.fit_preprocessor(DOC_SPEC, train)
    names = FE.slot_names(model, DOC_SPEC)
    long = FE.features_long(model.transform(d), names, "doc_id")
    return long.select("doc_id", "slot", F.round("value", 6).alias("value"))


@register("features_high_cardinality", """
WITH t AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0)
SELECT c_custkey, 'name_' || c_name AS slot, CAST(1.0 AS DOUBLE) AS value FROM customer WHERE c_name IN (SELECT c_name FROM t)
""")
def q_features_high_cardinality(spark, sf_dir):
    """FE4: a category with one value a row, fitted on two thirds of the customers; the others' names
    are unseen and have no slot."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    spec = FeatureSpec(categorical=("name",), target="y", lineage=None, key=("c_custkey",))
    long = WIDE.fit(spec, c.filter("c_custkey % 3 <> 0")).encode(c, "c_custkey")
    return long.select("c_custkey", F.col("feature").alias("slot"), "value")


WIDE_SPEC = FeatureSpec(numeric=("balance",), categorical=("segment", "name"), target="y", lineage=None, key=("id",))
_WIDE_SQL = """c AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, c_name AS name FROM customer),
cats AS (SELECT 0 AS pos, segment AS v FROM c UNION SELECT 1, name FROM c),
slots AS (SELECT CAST(0 AS BIGINT) AS slot, 'balance' AS feature, -1 AS pos, NULL AS v
  UNION ALL SELECT CAST(row_number() OVER (ORDER BY pos, v) AS BIGINT),
                   CASE pos WHEN 0 THEN 'segment_' ELSE 'name_' END || v, pos, v FROM cats)"""


def wide_customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("name"))


@register("features_wide_dictionary", f"WITH {_WIDE_SQL} SELECT slot, feature FROM slots")
def q_features_wide_dictionary(spark, sf_dir):
    """FE4: the slots of every category, ranked without a list of them anywhere."""
    return WIDE.fit(WIDE_SPEC, wide_customers(spark, sf_dir)).slots.select("slot", "feature")


_WIDE_LONG_SQL = """st AS (SELECT avg(balance) AS m, stddev_pop(balance) AS s, count(*) AS n FROM c),
long AS (SELECT id, CAST(0 AS BIGINT) AS slot, (balance - m) / s AS x FROM c JOIN st ON TRUE WHERE balance <> m
  UNION ALL SELECT id, slot, 1.0 FROM c JOIN slots ON pos = 0 AND v = segment
  UNION ALL SELECT id, slot, 1.0 FROM c JOIN slots ON pos = 1 AND v = name),
w AS (SELECT slot, feature, (slot % 7 - 3) / 8.0 AS coef,
             coalesce((SELECT sum(x) FROM long WHERE long.slot = slots.slot), 0) / (SELECT n FROM st) AS mean FROM slots)"""


def _wide_contributions(spark, sf_dir):
    c = wide_customers(spark, sf_dir)
    wide = WIDE.fit(WIDE_SPEC, c)
    long = materialize(wide.encode(c, "id"), "wide-entries")
    weights = wide.slots.select("slot", "feature", ((F.col("slot") % 7 - 3) / 8.0).alias("coef"))
    n = c.count()
    return *WIDE.linear_contributions(long, weights, n, "id"), n


@register("linear_contributions_sparse", f"""
WITH {_WIDE_SQL}, {_WIDE_LONG_SQL}
SELECT id, feature, round(coef * (x - mean), 6) + 0.0 AS contribution FROM long JOIN w USING (slot)
UNION ALL SELECT NULL, feature, round(-coef * mean, 6) + 0.0 FROM w
""")
def q_linear_contributions_sparse(spark, sf_dir):
    """Attributions of a wide declared model: a row for each stored entry and, with a NULL id, one
    for each slot that holds for all rows without an entry there."""
    stored, baseline, _ = _wide_contributions(spark, sf_dir)
    both = stored.unionByName(baseline.drop("n_stored"), allowMissingColumns=True)
    return both.select("id", "feature", (F.round("contribution", 6) + 0.0).alias("contribution"))


@register("mean_abs_attribution_sparse", f"""
WITH {_WIDE_SQL}, {_WIDE_LONG_SQL}, own AS (SELECT slot, sum(abs(coef * (x - mean))) AS t, count(*) AS k
  FROM long JOIN w USING (slot) GROUP BY slot)
SELECT feature, round((coalesce(t, 0) + (n - coalesce(k, 0)) * abs(coef * mean)) / n, 6) + 0.0 AS mean_abs
FROM w LEFT JOIN own USING (slot) JOIN st ON TRUE
""")
def q_mean_abs_attribution_sparse(spark, sf_dir):
    """Mean absolute attribution of every slot of the wide model."""
    g = WIDE.mean_abs_attribution(*_wide_contributions(spark, sf_dir))
    return g.select("feature", F.round("mean_abs", 6).alias("mean_abs"))


# ---------------------------------------------------------------------------------------------
# Models, search, stacking, explanations (M1-M10, ST1-ST5, X1, X2, X4, X5). Model fits are
# iterative optimisations, not SQL: these queries are rows-only for the driver and covered by
# unit tests (Newton solve, additivity, reload). Grids stay tiny here; bench.py runs bigger.

from tabflow.plans import ensemble as EN  # noqa: E402
from tabflow.plans import explain as X  # noqa: E402
from tabflow.plans import train as TR  # noqa: E402

MODEL_FOLDS = 3


def doc_model_frames(spark, sf_dir):
    """Labelled documents → train/test split → features fitted on train → folds on train."""
    d = documents_features_input(spark, sf_dir).filter(F.col("quality").isNotNull()) \
        .withColumn("label", F.col("quality").cast("double")).withColumnRenamed("doc_id", "row_id")
    spec = FeatureSpec(numeric=DOC_SPEC.numeric, categorical=DOC_SPEC.categorical,
                       binary=DOC_SPEC.binary, target="label", lineage=None, key=("row_id",))
    # the preprocessor fits several statistics: rank the split once
    s = materialize(SP.stratified_split(d, "label", 0.2, 42, "row_id"), "doc-split")
    train, test = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")
    pre = FE.fit_preprocessor(spec, train)
    train_x = SP.stratified_folds(pre.transform(train), "label", MODEL_FOLDS, 42, "row_id") \
        .select("row_id", "label", "features", "fold")
    test_x = pre.transform(test).select("row_id", "label", "features")
    # every model fit below is many Spark jobs over these frames: write them once
    return (materialize(train_x, "doc-train"), materialize(test_x, "doc-test"),
            FE.slot_names(pre, spec))


@register("model_lr_coefficients")
def q_model_lr(spark, sf_dir):
    """Penalised logistic regression (C=1), coefficients by |value|."""
    train, _, names = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("lr", {"C": 1.0}).fit(train)
    return X.coefficients(m, names)


@register("model_rf_importances")
def q_model_rf(spark, sf_dir):
    """Random forest, top 10 importances."""
    train, _, names = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("rf", {"n_estimators": 20, "max_depth": 5}).fit(train)
    return X.importances(m, names, k=10)


@register("model_gbt_evaluate")
def q_model_gbt(spark, sf_dir):
    """Boosted trees scored on test and train, evaluated together."""
    train, test, _ = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("gbt", {"n_estimators": 10, "learning_rate": 0.1}).fit(train)
    scores = TR.predict(m, test, ["row_id"], name="gbt_test").unionByName(
        TR.predict(m, train.drop("fold"), ["row_id"], name="gbt_train"))
    return M.evaluate(scores)


@register("model_search")
def q_model_search(spark, sf_dir):
    """Cross-validated grid search over fixed stratified folds, best refitted."""
    train, _, _ = doc_model_frames(spark, sf_dir)
    return TR.search("lr", train, {"C": [0.1, 1.0]}, k=MODEL_FOLDS, n_iter=20).results


@register("model_cv_score")
def q_model_cv(spark, sf_dir):
    """M7: mean and population std of fold AUCs for a fixed model."""
    train, _, _ = doc_model_frames(spark, sf_dir)
    mean, std = TR.cv_score(TR.make_estimator("lr", {"C": 1.0}), train, MODEL_FOLDS)
    return spark.createDataFrame([("lr", mean, std)], "model string, cv_mean_auc double, cv_std_auc double")


@register("stack_evaluate")
def q_stack(spark, sf_dir):
    """ST1-ST5: out-of-fold base scores → meta logistic model → stacked test metrics."""
    train, test, _ = doc_model_frames(spark, sf_dir)
    est = {"lr": TR.make_estimator("lr", {"C": 1.0}),
           "rf": TR.make_estimator("rf", {"n_estimators": 10, "max_depth": 4})}
    _, _, stacked = EN.run_stack(est, train, test, MODEL_FOLDS)
    return M.evaluate(stacked).join(M.class_report(stacked).filter(F.col("cls") == "weighted_avg")
                                    .select("model", F.col("f1").alias("weighted_f1")), "model")


LINEAR_COEFS = {"l_quantity": 0.02, "l_extendedprice": 0.00001, "l_discount": 3.0, "l_tax": -2.0}
# "+ 0.0" in the oracles turns a rounded -0.0 into 0.0, as Spark's decimal rounding does.
_CONTRIB_SQL = f"""(WITH m AS (SELECT avg(l_quantity) AS q, avg(l_extendedprice) AS e, avg(l_discount) AS d,
                         avg(l_tax) AS t FROM lineitem)
  SELECT {_LINE_KEY_SQL} AS row_id, 'l_quantity' AS feature, 0.02 * (l_quantity - q) AS contribution
    FROM lineitem JOIN m ON TRUE
  UNION ALL SELECT {_LINE_KEY_SQL}, 'l_extendedprice', 0.00001 * (l_extendedprice - e) FROM lineitem JOIN m ON TRUE
  UNION ALL SELECT {_LINE_KEY_SQL}, 'l_discount', 3.0 * (l_discount - d) FROM lineitem JOIN m ON TRUE
  UNION ALL SELECT {_LINE_KEY_SQL}, 'l_tax', -2.0 * (l_tax - t) FROM lineitem JOIN m ON TRUE)"""


def _line_contributions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("row_id", line_key())
    names = list(LINEAR_COEFS)
    means = li.agg(*[F.avg(c) for c in names]).first()
    return X.linear_contributions(li, list(LINEAR_COEFS.values()), list(means), names, "row_id",
                                  features=None)


@register("linear_contributions", f"""
SELECT row_id, feature, round(contribution, 6) + 0.0 AS contribution FROM {_CONTRIB_SQL}
""")
def q_linear_contributions(spark, sf_dir):
    """Per-row additive attributions of a declared linear model over every lineitem row."""
    c = _line_contributions(spark, sf_dir)
    return c.select("row_id", "feature", F.round("contribution", 6).alias("contribution"))


@register("mean_abs_attribution", f"""
SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs FROM {_CONTRIB_SQL}
GROUP BY feature ORDER BY mean_abs DESC, feature LIMIT 3
""")
def q_mean_abs_attribution(spark, sf_dir):
    """Global ranking by mean |attribution|, top 3."""
    g = X.mean_abs_attribution(_line_contributions(spark, sf_dir))
    return M.top_k(g.withColumn("mean_abs", F.round("mean_abs", 6)), "mean_abs", 3, "feature")


from tabflow.plans import treeshap as TS  # noqa: E402


@register("tree_contributions")
def q_tree_contributions(spark, sf_dir):
    """Exact per-row attributions of a random forest for every labelled document (train and
    test)."""
    train, test, names = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("rf", {"n_estimators": 20, "max_depth": 5}).fit(train)
    rows = train.select("row_id", "features").unionByName(test.select("row_id", "features"))
    return TS.tree_contributions(m, rows, names)


# ---------------------------------------------------------------------------------------------
# What holds of every fit, whatever its numbers: SQL cannot fit a model, but it can say which rows,
# folds and slots must come out, and the Spark side reduces the rest to statements that must be true.

_DOC_FOLDS_SQL = f"""(SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality
        ORDER BY {_hash_sql('doc_id', 42)}, doc_id) - 1) % {MODEL_FOLDS} AS fold FROM {_DOC_TRAIN_SQL})"""


@register("describe_approx_bounds", f"""
SELECT DISTINCT column_name, TRUE AS p25_ok, TRUE AS p50_ok, TRUE AS p75_ok FROM {_LINE_LONG}
""")
def q_describe_approx_bounds(spark, sf_dir):
    """A2: the sketch's quantiles lie within its promised rank error, by exact counts over all rows."""
    df, accuracy = lineitem_holes(spark, sf_dir), 1000
    d = P.describe_approx(df, LINE_NUMERIC, accuracy)
    long = P.to_long(P.numeric_view(df, list(LINE_NUMERIC)), list(LINE_NUMERIC)).filter(F.col("value").isNotNull())
    qs = ("p25", "p50", "p75")
    ranks = long.join(d.select("column_name", "count", *qs), "column_name").groupBy("column_name", "count").agg(
        *[F.count_if(F.col("value") < F.col(q)).alias(f"{q}_below") for q in qs],
        *[F.count_if(F.col("value") <= F.col(q)).alias(f"{q}_upto") for q in qs])
    slack = F.col("count") / accuracy + 1
    return ranks.select("column_name", *[
        ((F.col(f"{q}_below") <= p * F.col("count") + slack) & (F.col(f"{q}_upto") >= p * F.col("count") - slack))
        .alias(f"{q}_ok") for q, p in zip(qs, (0.25, 0.5, 0.75))])


@register("model_lr_gradient", f"""
SELECT 'n_chars' AS slot, TRUE AS stationary UNION ALL SELECT 'toxic', TRUE UNION ALL SELECT 'intercept', TRUE
UNION ALL SELECT DISTINCT 'lang_' || coalesce(lang, 'missing'), TRUE FROM {_DOC_TRAIN_SQL}
UNION ALL SELECT DISTINCT 'source_' || coalesce(source, 'missing'), TRUE FROM {_DOC_TRAIN_SQL}
""")
def q_model_lr_gradient(spark, sf_dir):
    """M1: at the fitted weights the gradient of the penalised loss vanishes in every slot."""
    from pyspark.ml.functions import vector_to_array
    train, _, names = doc_model_frames(spark, sf_dir)
    m = TR.PenalizedLogit(C=1.0, tol=1e-8).fit(train)
    n, w = train.count(), [*m.coefficients.toArray().tolist(), 0.0]
    err = F.col("score") - F.col("label")
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    sums = (TR.positive_score(m.transform(train)).select(err.alias("err"), F.posexplode(x).alias("pos", "x"))
            .groupBy("pos").agg(F.sum(F.col("err") * F.col("x")).alias("g")))
    slots = spark.createDataFrame(list(zip(range(len(w)), [*names, "intercept"], w)), "pos int, slot string, w double")
    return sums.join(slots, "pos").select("slot", (F.abs(F.col("g") + F.col("w")) / n < 1e-4).alias("stationary"))


@register("model_lr_coefficients_stationary", f"""
SELECT 'n_chars' AS feature, TRUE AS stationary UNION ALL SELECT 'toxic', TRUE
UNION ALL SELECT DISTINCT 'lang_' || coalesce(lang, 'missing'), TRUE FROM {_DOC_TRAIN_SQL}
UNION ALL SELECT DISTINCT 'source_' || coalesce(source, 'missing'), TRUE FROM {_DOC_TRAIN_SQL}
""")
def q_model_lr_coefficients_stationary(spark, sf_dir):
    """The reported coefficients, by their names, are the weights at which the gradient vanishes."""
    train, _, names = doc_model_frames(spark, sf_dir)
    m = TR.PenalizedLogit(C=1.0, tol=1e-8).fit(train)
    scored = TR.positive_score(m.transform(train)).withColumn("err", F.col("score") - F.col("label"))
    sums = (FE.features_long(scored, names, ["err"]).groupBy(F.col("slot").alias("feature"))
            .agg(F.sum(F.col("err") * F.col("value")).alias("g")))
    return (X.coefficients(m, names).join(sums, "feature", "left")
            .select("feature", (F.abs(F.coalesce("g", F.lit(0.0)) + F.col("coefficient")) / train.count() < 1e-4)
                    .alias("stationary")))


PRESET_C = [0.0001, 0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0, 20000.0, 50000.0]
_LINE_FOLD_SQL = """(SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_orderkey % 5 AS fold,
  l_quantity AS score FROM lineitem)"""


def lineitem_folds(spark, sf_dir, slots: list[str]) -> DataFrame:
    """(row_id, label, fold, features) of every line: whether it was returned, folds by whole orders."""
    from pyspark.ml.feature import VectorAssembler
    li = table(spark, sf_dir, "lineitem").select(
        line_key().alias("row_id"), (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.pmod("l_orderkey", F.lit(5)).cast("int").alias("fold"), (F.col("l_quantity") / 50).alias("quantity"),
        (F.col("l_extendedprice") / 50000).alias("price"), (F.col("l_discount") * 10).alias("discount"),
        (F.col("l_tax") * 10).alias("tax"))
    return materialize(VectorAssembler(inputCols=slots, outputCol="features").transform(li)
                       .select("row_id", "label", "fold", "features"), "line-folds")


@register("model_lr_grid", f"""
SELECT c AS C, CAST(f AS INTEGER) AS fold, CAST(count_if(fold <> f) AS BIGINT) AS n_train,
       CAST(sum(label) FILTER (fold <> f) AS BIGINT) AS n_positive, TRUE AS stationary
FROM {_LINE_FOLD_SQL}, (SELECT unnest([{", ".join(f"{c}::DOUBLE" for c in PRESET_C)}]) AS c), range(5) r(f) GROUP BY c, f
""")
def q_model_lr_grid(spark, sf_dir):
    """M1/M5: the preset grid's 11 × 5 fits over all lines in as many passes as the slowest one needs;
    at every pair's weights the gradient of its penalised loss, taken anew by SQL functions, vanishes."""
    from pyspark.ml.functions import vector_to_array

    from tabflow.plans import logit_grid as LG
    df = lineitem_folds(spark, sf_dir, ["quantity", "price", "discount", "tax"])
    grid = LG.fit_grid(df, PRESET_C, 5)
    pairs = F.array(*[F.struct(F.lit(C).alias("C"), F.lit(f).alias("out"), *[F.lit(float(v)).alias(f"w{i}") for i, v in enumerate(w)])
                      for C, of in zip(grid.Cs, grid.weights, strict=True) for f, w in enumerate(of)])
    x = vector_to_array("features")
    rows = (df.select("label", "fold", F.lit(1.0).alias("x0"), *[x[i].alias(f"x{i + 1}") for i in range(4)])
            .select("*", F.inline(pairs)).filter("fold <> out"))
    margin = reduce(lambda a, b: a + b, [F.col(f"x{i}") * F.col(f"w{i}") for i in range(5)])
    sums = (rows.withColumn("err", 1 / (1 + F.exp(-margin)) - F.col("label")).groupBy("C", F.col("out").alias("fold"))
            .agg(F.count(F.lit(1)).alias("n_train"), F.sum("label").cast("bigint").alias("n_positive"),
                 *[F.sum(F.col("err") * F.col(f"x{i}")).alias(f"g{i}") for i in range(5)],
                 *[F.first(f"w{i}").alias(f"w{i}") for i in range(1, 5)]))
    slots = [F.abs(F.col(f"g{i}") + (F.col(f"w{i}") / F.col("C") if i else 0)) / F.col("n_train") < 1e-9 for i in range(5)]
    return sums.select("C", "fold", "n_train", "n_positive", reduce(lambda a, b: a & b, slots).alias("stationary"))


@register("search_fold_auc", f"""
WITH s AS (SELECT * FROM {_LINE_FOLD_SQL}),
way AS (SELECT f, CASE WHEN covar_pop(label, score) FILTER (fold <> f) > 0 THEN 1 ELSE -1 END AS sign
        FROM s, range(5) r(f) GROUP BY f),
auc AS ({_AUC_SQL.format(g='fold', src='s')})
SELECT c AS C, CAST(fold AS INTEGER) AS fold, round(CASE WHEN sign = 1 THEN roc_auc ELSE 1 - roc_auc END, 6) AS roc_auc
FROM auc JOIN way ON fold = f, (SELECT unnest([{", ".join(f"{c}::DOUBLE" for c in PRESET_C)}]) AS c)
""")
def q_search_fold_auc(spark, sf_dir):
    """M5: every candidate's AUC in every fold, by the fit that did not see it. With one slot the order
    of the scores is the slot's, by the sign of its covariance with the label outside the fold."""
    from tabflow.plans import logit_grid as LG
    df = lineitem_folds(spark, sf_dir, ["quantity"])
    grid = LG.fit_grid(df, PRESET_C, 5)
    scores = LG.held_out_scores(df, grid, []).withColumn("pair", F.col("candidate") * 5 + F.col("fold"))
    c = F.element_at(F.array(*map(F.lit, PRESET_C)), F.floor(F.col("pair") / 5).cast("int") + 1)
    return _r6(M.roc_auc(scores, model="pair").select(c.alias("C"), F.pmod("pair", F.lit(5)).alias("fold"), "roc_auc"), ["roc_auc"])


@register("model_rf_importance_sum", f"""
SELECT CAST(2 + count(DISTINCT coalesce(lang, 'missing')) + count(DISTINCT coalesce(source, 'missing')) AS BIGINT) AS n_slots,
       TRUE AS sums_to_one, TRUE AS none_negative FROM {_DOC_TRAIN_SQL}
""")
def q_model_rf_importance_sum(spark, sf_dir):
    """One importance a slot; they are shares of 1."""
    train, _, names = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("rf", {"n_estimators": 20, "max_depth": 5}).fit(train)
    imp = X.importances(m, names, k=len(names))
    value = [c for c, t in imp.dtypes if t == "double"][0]
    return imp.agg(F.count(F.lit(1)).cast("bigint").alias("n_slots"),
                   (F.abs(F.sum(value) - 1) < 1e-9).alias("sums_to_one"), (F.min(value) >= 0).alias("none_negative"))


@register("model_gbt_counts", f"""
SELECT 'gbt_train' AS model, quality AS label, CAST(count(*) AS BIGINT) AS n, TRUE AS accuracy_ok, TRUE AS prediction_ok
FROM {_DOC_TRAIN_SQL} GROUP BY quality
UNION ALL SELECT 'gbt_test', quality, CAST(count(*) AS BIGINT), TRUE, TRUE FROM {_DOC_SQL}
WHERE quality IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM {_DOC_TRAIN_SQL}) GROUP BY quality
""")
def q_model_gbt_counts(spark, sf_dir):
    """Every row is scored once, predictions follow the scores, accuracies follow the rows."""
    train, test, _ = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("gbt", {"n_estimators": 5, "learning_rate": 0.1}).fit(train)
    scores = materialize(TR.predict(m, test, ["row_id"], name="gbt_test").unionByName(
        TR.predict(m, train.drop("fold"), ["row_id"], name="gbt_train")), "gbt-scores")
    rows = scores.groupBy("model").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("share"))
    ok = M.evaluate(scores).join(rows, "model").select("model", (F.abs(F.col("accuracy") - F.col("share")) < 1e-9)
                                                       .alias("accuracy_ok"))
    per = scores.groupBy("model", "label").agg(
        F.countDistinct("row_id").cast("bigint").alias("n"),
        F.bool_and((F.col("score") > 0.5).cast("int") == F.col("prediction")).alias("prediction_ok"))
    return per.join(ok, "model").select("model", "label", "n", "accuracy_ok", "prediction_ok")


_BOOST_SQL = """WITH d AS (SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS y, CAST(l_discount > 0.05 AS INTEGER) AS side FROM lineitem),
m AS (SELECT avg(y) AS p FROM d),
s AS (SELECT side, count(*) AS n, sum(p - y) AS g, sum(p * (1 - p)) AS h FROM d, m GROUP BY side),
t AS (SELECT sum(g) AS g, sum(h) AS h, sum(n) AS n FROM s),
k AS (SELECT (SELECT sum(g * g / (h + 2)) FROM s) - g * g / (h + 2) > 2e-12 AS split FROM t)
SELECT side + 1 AS node, CAST(n AS BIGINT) AS n, round(g, 6) AS g, round(h, 6) AS h, round(-0.3 * g / (h + 2), 9) AS value
FROM s, k WHERE split
UNION ALL SELECT 0, CAST(n AS BIGINT), round(g, 6), round(h, 6), round(-0.3 * g / (h + 2), 9) FROM t, k WHERE NOT split"""


@register("model_boost_leaves", f"SELECT node, n, g + 0.0 AS g, h, value + 0.0 AS value FROM ({_BOOST_SQL})")
def q_model_boost_leaves(spark, sf_dir):
    """M3: one second-order tree of one test over all lines; its leaves' sums and weights, -step · G/(H+λ)."""
    from pyspark.ml.feature import VectorAssembler

    from tabflow.plans.boost import SecondOrderTrees
    li = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "R").cast("double").alias("label"),
                                                 (F.col("l_discount") > 0.05).cast("double").alias("side"))
    df = VectorAssembler(inputCols=["side"], outputCol="features").transform(li)
    m = SecondOrderTrees(maxIter=1, maxDepth=1, stepSize=0.3, regLambda=2.0).fit(df)
    leaves = m.node_table(spark).filter("slot < 0")
    return leaves.select("node", "n", (F.round("g", 6) + 0.0).alias("g"), F.round("h", 6).alias("h"),
                         (F.round("value", 9) + 0.0).alias("value"))


@register("model_boost_rounds", f"""
SELECT CAST(r AS INTEGER) AS round, (SELECT CAST(count(*) AS BIGINT) FROM {_DOC_TRAIN_SQL}) AS n_rows, TRUE AS falls,
       TRUE AS weights_ok FROM range(6) t(r)
""")
def q_model_boost_rounds(spark, sf_dir):
    """M3: the training loss falls every round; every tree's root holds all rows, and every leaf weighs
    what its own sums say."""
    from tabflow.plans.boost import SecondOrderTrees
    train, _, _ = doc_model_frames(spark, sf_dir)
    m = SecondOrderTrees(maxIter=6, maxDepth=3, stepSize=0.3).fit(train)
    after = -F.avg(F.when(F.col("label") == 1, F.log("score")).otherwise(F.log(1 - F.col("score"))))
    last = TR.positive_score(m.transform(train)).agg(after.alias("l")).first()["l"]
    steps = [*m.losses, last]
    falls = spark.createDataFrame([(i, a > b) for i, (a, b) in enumerate(zip(steps, steps[1:]))], "round int, falls boolean")
    nodes = m.node_table(spark).groupBy(F.col("tree").alias("round")).agg(
        F.max(F.when(F.col("node") == 0, F.col("n"))).alias("n_rows"),
        F.bool_and((F.col("slot") >= 0) | (F.abs(F.col("value") + 0.3 * F.col("g") / (F.col("h") + 1)) < 1e-12)).alias("weights_ok"))
    return falls.join(nodes, "round").select("round", "n_rows", "falls", "weights_ok")


@register("model_search_sample", f"""
SELECT CAST(3 AS BIGINT) AS n_candidates, CAST(1 AS BIGINT) AS n_best, TRUE AS best_is_greatest, TRUE AS mean_ok,
       (SELECT CAST(count(*) AS BIGINT) FROM {_DOC_TRAIN_SQL}) AS n_scored
""")
def q_model_search_sample(spark, sf_dir):
    """Exactly n_iter of the grid's six candidates, one best, and its mean fold AUC again
    from its stored held-out scores, of which every training row has one."""
    train, _, _ = doc_model_frames(spark, sf_dir)
    sr = TR.search("lr", train, {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]}, k=MODEL_FOLDS, n_iter=3)
    again = P.mean_std(M.roc_auc(sr.oof, model="fold"), "roc_auc").first()["mean"]
    best = F.max(F.when(F.col("is_best"), F.col("mean_auc")))
    return sr.results.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_candidates"), F.count_if("is_best").cast("bigint").alias("n_best"),
        (best == F.max("mean_auc")).alias("best_is_greatest"), (F.abs(best - again) < 1e-9).alias("mean_ok")) \
        .withColumn("n_scored", F.lit(sr.oof.select("row_id").distinct().count()).cast("bigint"))


@register("model_cv_bounds", "SELECT 'lr' AS model, TRUE AS mean_ok, TRUE AS std_ok")
def q_model_cv_bounds(spark, sf_dir):
    """M7: mean and deviation agree with the fold AUCs of the same fits' held-out scores."""
    train, _, _ = doc_model_frames(spark, sf_dir)
    mean, std = TR.cv_score(TR.make_estimator("lr", {"C": 1.0}), train, MODEL_FOLDS)
    oof = EN.oof_scores({"lr": TR.make_estimator("lr", {"C": 1.0})}, train, MODEL_FOLDS)
    folds = oof.join(train.select("row_id", "fold"), "row_id")
    return P.mean_std(M.roc_auc(folds, model="fold"), "roc_auc").select(
        F.lit("lr").alias("model"), (F.abs(F.col("mean") - mean) < 1e-6).alias("mean_ok"),
        (F.abs(F.col("std") - std) < 1e-6).alias("std_ok"))


@register("stack_oof_counts", f"""
SELECT model, fold, quality AS label, CAST(count(*) AS BIGINT) AS n
FROM {_DOC_FOLDS_SQL}, (SELECT unnest(['lr', 'rf']) AS model) GROUP BY ALL
""")
def q_stack_oof_counts(spark, sf_dir):
    """ST1-ST3: every training row is scored once per base model, by fold and label."""
    train, _, _ = doc_model_frames(spark, sf_dir)
    est = {"lr": TR.make_estimator("lr", {"C": 1.0}), "rf": TR.make_estimator("rf", {"n_estimators": 5, "max_depth": 3})}
    oof = EN.oof_scores(est, train, MODEL_FOLDS)
    return (oof.join(train.select("row_id", F.col("fold").cast("bigint").alias("fold")), "row_id")
            .groupBy("model", "fold", "label").agg(F.count("score").cast("bigint").alias("n")))


@register("stack_test_rows", f"""
SELECT doc_id AS row_id, quality AS label, TRUE AS score_ok, TRUE AS prediction_ok FROM {_DOC_SQL}
WHERE quality IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM {_DOC_TRAIN_SQL})
""")
def q_stack_test_rows(spark, sf_dir):
    """ST4/ST5: every test row has one stacked score, the meta model's value of its base scores."""
    train, test, _ = doc_model_frames(spark, sf_dir)
    est = {"lr": TR.make_estimator("lr", {"C": 1.0}), "rf": TR.make_estimator("rf", {"n_estimators": 5, "max_depth": 3})}
    meta, base, stacked = EN.run_stack(est, train, test, MODEL_FOLDS)
    w, b = meta.coefficients.toArray().tolist(), float(meta.intercept)
    wide = M.score_columns(EN.base_scores(base, test), list(est)).withColumn(
        "_p", 1 / (1 + F.exp(-(F.col("lr") * w[0] + F.col("rf") * w[1] + b))))
    return stacked.join(wide.select("row_id", "_p"), "row_id").select(
        "row_id", "label", (F.abs(F.col("score") - F.col("_p")) < 1e-9).alias("score_ok"),
        ((F.col("score") > 0.5).cast("int") == F.col("prediction")).alias("prediction_ok"))


@register("tree_contributions_sum", f"""
SELECT doc_id AS row_id, TRUE AS additive FROM {_DOC_SQL} WHERE quality IS NOT NULL
""")
def q_tree_contributions_sum(spark, sf_dir):
    """For every row, base value plus attributions is the forest's score."""
    train, test, names = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("rf", {"n_estimators": 10, "max_depth": 5}).fit(train)
    rows = train.select("row_id", "features").unionByName(test.select("row_id", "features"))
    sums = TS.tree_contributions(m, rows, names).groupBy("row_id").agg(F.sum("contribution").alias("s"))
    base = TS.expected_value(m, spark)
    return (TR.positive_score(m.transform(rows)).join(sums, "row_id", "left")
            .select("row_id", (F.abs(F.coalesce("s", F.lit(0.0)) + base - F.col("score")) < 1e-6).alias("additive")))


@register("tree_contributions_deep", f"""
SELECT doc_id AS row_id, TRUE AS additive FROM {_DOC_SQL} WHERE quality IS NOT NULL
""")
def q_tree_contributions_deep(spark, sf_dir):
    """X3 at the preset grid's size: 300 trees of up to ten tests a path, every labelled document."""
    train, test, names = doc_model_frames(spark, sf_dir)
    m = TR.make_estimator("rf", {"n_estimators": 300, "max_depth": 10}).fit(train)
    rows = train.select("row_id", "features").unionByName(test.select("row_id", "features"))
    sums = TS.tree_contributions(m, rows, names).groupBy("row_id").agg(F.sum("contribution").alias("s"))
    base = TS.expected_value(m, spark)
    return (TR.positive_score(m.transform(rows)).join(sums, "row_id", "left")
            .select("row_id", (F.abs(F.coalesce("s", F.lit(0.0)) + base - F.col("score")) < 1e-6).alias("additive")))


@register("missing_source", """
SELECT 'customer' AS source, TRUE AS found, CAST(count(*) AS BIGINT) AS n_rows FROM customer
UNION ALL SELECT 'absent', FALSE, CAST(0 AS BIGINT)
""")
def q_missing_source(spark, sf_dir):
    """A source whose path does not exist counts as none, the others are read."""
    folder = run_path(spark, "sources")
    io.write_table(table(spark, sf_dir, "customer"), f"{folder}/customer", fmt="csv")
    read = {n: io.read_raw(spark, f"{folder}/{n}", missing_ok=True) for n in ("customer", "absent")}
    rows = spark.createDataFrame([(n, df is not None) for n, df in read.items()], "source string, found boolean")
    counts = reduce(lambda a, b: a.unionByName(b), [df.agg(F.count("*").alias("n_rows")).withColumn("source", F.lit(n))
                                                    for n, df in read.items() if df is not None])
    return rows.join(counts, "source", "left").fillna(0, ["n_rows"])


@register("combine_cached", """
SELECT 'customer' AS source, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS BIGINT)
  AS n_positive FROM customer
UNION ALL SELECT 'supplier', count(*), sum(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END) FROM supplier
""")
def q_combine_cached(spark, sf_dir):
    """The combined rows of two sources, stored by the first call and read again by the second."""
    from tabflow.plans import workflow as WF
    spec = FeatureSpec(numeric=("acctbal",), categorical=("segment",), target="label", lineage="source", key=("id",))
    folder = run_path(spark, "stage-cache")

    def rows():
        customer = table(spark, sf_dir, "customer").withColumn("label", (F.col("c_acctbal") > 0).cast("int"))
        supplier = table(spark, sf_dir, "supplier").withColumn("label", (F.col("s_acctbal") > 0).cast("int"))
        return WF.combined_rows([(customer, CUSTOMER_SRC), (supplier, SUPPLIER_SRC)], spec, folder)
    rows()
    return rows().groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("label").cast("bigint").alias("n_positive"))


@register("csv_round_trip", """
SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment
FROM customer
""")
def q_csv_round_trip(spark, sf_dir):
    """Customers written as CSV part files (one segment as an NA marker, names quoted) and read
    back as text, then typed."""
    from tabflow.sources.io import read_raw, write_table
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"),
                                                F.regexp_replace("c_mktsegment", "^BUILDING$", "N/A").alias("c_mktsegment"))
    path = run_path(spark, "csv")
    write_table(c.repartition(3), path, fmt="csv")
    raw = read_raw(spark, path)
    return raw.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                      F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


@register("runs_appended", """
SELECT CAST(2 AS BIGINT) AS n_runs, (SELECT CAST(2 * count(DISTINCT l_returnflag) AS BIGINT) FROM lineitem) AS n_metrics,
       (SELECT round(2 * sum(q), 6) FROM (SELECT avg(l_quantity) AS q FROM lineitem GROUP BY l_returnflag)) AS metric_sum
""")
def q_runs_appended(spark, sf_dir):
    """Two runs' records, made from grouped metrics, appended and read back."""
    from tabflow.plans import runlog as RL
    path, timer = run_path(spark, "runs"), RL.StageTimer()
    ev = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("l_quantity").alias("f1"))
    for run_id in ("a", "b"):
        long = RL.metrics_long(ev, run_id)
        RL.append_records(RL.run_record(spark, long, run_id, "test", timer, {}), long, path)
    runs, long = spark.read.parquet(f"{path}/runs"), spark.read.parquet(f"{path}/metrics")
    total = runs.select(F.explode(F.map_values("metrics")).alias("v")).agg(F.round(F.sum("v"), 6).alias("metric_sum"))
    return total.select(F.lit(runs.count()).cast("bigint").alias("n_runs"), F.lit(long.count()).cast("bigint").alias("n_metrics"),
                        "metric_sum")


@register("model_reloaded", f"SELECT doc_id AS row_id, TRUE AS same_score FROM {_DOC_TRAIN_SQL}")
def q_model_reloaded(spark, sf_dir):
    """A stored model, read back, gives every row the score it gave before."""
    from pyspark.ml import PipelineModel

    from tabflow.sources.io import load_model, save_model
    train, _, _ = doc_model_frames(spark, sf_dir)
    m = PipelineModel(stages=[TR.make_estimator("lr", {"C": 1.0}).fit(train)])
    path = run_path(spark, "model")
    save_model(m, train, path)
    a, b = (TR.positive_score(x.transform(train)).select("row_id", "score") for x in (m, load_model(path)))
    return a.join(b.withColumnRenamed("score", "again"), "row_id").select(
        "row_id", (F.col("score") == F.col("again")).alias("same_score"))


from tabflow.plans import workflow as WF  # noqa: E402
from tabflow.spec import GridSpec, StackSpec  # noqa: E402

DOC_SOURCE = SourceSpec(name="documents", rename={"quality": "label"}, overwrite_tag=True)
WORKFLOW_SPEC = FeatureSpec(numeric=("n_chars",), categorical=("lang", "source_name"), binary=("toxic",),
                            target="label", lineage="source", key=("doc_id",))
WORKFLOW_GRIDS = (GridSpec("lr", {"C": [0.1, 1.0]}), GridSpec("rf", {"n_estimators": [10], "max_depth": [4]}),
                  GridSpec("gbt", {"n_estimators": [5], "learning_rate": [0.1]}))


@register("workflow_run")
def q_workflow_run(spark, sf_dir):
    """The whole analysis end to end (harmonise → clean → profile → split → features → search →
    evaluate → stack → CV → explain → record) on the labelled documents; returns the run's long
    metrics (the record's content)."""
    docs = documents_features_input(spark, sf_dir).withColumnRenamed("source", "source_name")
    res = WF.run(spark, [(docs, DOC_SOURCE)], WORKFLOW_SPEC, grids=WORKFLOW_GRIDS, k=3,
                 stack=StackSpec(base=("lr", "rf", "gbt"), folds=3), profile=False)
    return res.metrics
