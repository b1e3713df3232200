"""The driver contract: entry runs, every query has an oracle unless it is a model fit."""

import re

import __spark_entry__ as E

ROWS_ONLY = {"describe_approx", "model_lr_coefficients", "model_rf_importances",
             "model_gbt_evaluate", "model_search", "model_cv_score", "stack_evaluate",
             "tree_contributions", "workflow_run"}
# The text operators may be absent; their rows-only queries are tested beside them.
TEXT = {"pipeline"} | {q for q in E.queries() if re.match(r"op\d+_", q)}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "segment", "n", "avg_bal"]


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) <= ROWS_ONLY | TEXT


def test_sql_queries_match_oracle_on_small_fixture(spark):
    import duckdb
    from tools.check_oracle import TABLES, digest
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        sdf = E.queries()[name](spark, sf)
        rel = con.execute(sql)
        d_cols = [d[0] for d in rel.description]
        assert sorted(sdf.columns) == sorted(d_cols), name
        assert digest(sdf.columns, [tuple(r) for r in sdf.collect()])[0] == \
            digest(d_cols, rel.fetchall())[0], name
