"""Wide vocabularies: dictionary table, sparse entries, sparse attributions."""

from pyspark.sql import functions as F

from tabflow.plans import explain as X
from tabflow.plans import features as FE
from tabflow.plans import wide as W
from tabflow.spec import FeatureSpec

SPEC = FeatureSpec(numeric=("x", "none"), categorical=("a", "b"), binary=("flag",), target="y", lineage=None, key=("id",))


def _rows(spark):
    # a third of all rows share one category; NULLs, repeats and an all-missing numeric column
    rows = [(i, float(i % 11) if i % 5 else None, None, "hot" if i % 3 == 0 else f"v{i}", None if i % 7 == 0 else f"b{i % 4}",
             float(i % 2)) for i in range(300)]
    return spark.createDataFrame(rows + rows[:2], "id long, x double, none double, a string, b string, flag double")


def test_entries_equal_the_vectors(spark):
    df = _rows(spark)
    train = df.filter("id < 200")
    wide, model = W.fit(SPEC, train), FE.fit_preprocessor(SPEC, train)
    names = FE.slot_names(model, SPEC)
    assert [r.feature for r in wide.slots.orderBy("slot").collect()] == names
    assert [r.slot for r in wide.slots.orderBy("slot").collect()] == list(range(wide.width))
    long = wide.encode(df, "id")
    got = sorted((r.id, r.feature, round(r.value, 9)) for r in long.collect())
    want = sorted((r.id, r.slot, round(r.value, 9)) for r in FE.features_long(model.transform(df), names, "id").collect())
    assert got == want
    for r in W.sparse_rows(long.filter("id > 1"), "id").collect():
        assert r.indices == sorted(r.indices) and len(r.indices) == len(r["values"])


def test_sparse_attributions_equal_dense(spark):
    df = _rows(spark).withColumn("id", F.monotonically_increasing_id())
    wide, model = W.fit(SPEC, df), FE.fit_preprocessor(SPEC, df)
    names = FE.slot_names(model, SPEC)
    coefs = [((j * 5) % 7 - 3) / 4 for j in range(len(names))]
    x = model.transform(df)
    dense = {(r.id, r.feature): r.contribution for r in
             X.linear_contributions(x, coefs, X.feature_means(x), names, "id").collect()}
    weights = spark.createDataFrame([(j, n, c) for j, (n, c) in enumerate(zip(names, coefs))], "slot long, feature string, coef double")
    long, n = wide.encode(df, "id"), df.count()
    stored, baseline = W.linear_contributions(long, weights, n, "id")
    assert stored.count() == long.count() < len(dense)
    own = {(r.id, r.feature): r.contribution for r in stored.collect()}
    base = {r.feature: r.contribution for r in baseline.collect()}
    for (i, f), value in dense.items():
        assert abs(own.get((i, f), base[f]) - value) < 1e-9
    means = {r.feature: r.mean_abs for r in W.mean_abs_attribution(stored, baseline, n).collect()}
    for f in names:
        assert abs(means[f] - sum(abs(v) for (_, g), v in dense.items() if g == f) / n) < 1e-9


def test_no_category_in_the_plan_and_empty_table(spark):
    df = _rows(spark)
    plan = W.fit(SPEC, df).encode(df, "id")._jdf.queryExecution().toString()
    assert "v298" not in plan and "UDF" not in plan
    empty = df.limit(0)
    wide = W.fit(SPEC, empty)
    assert wide.encode(empty, "id").count() == 0
    assert wide.slots.filter("_at IS NOT NULL").count() == 0


def test_second_run_reads_the_stored_rows(spark, tmp_dir, monkeypatch):
    from tabflow.plans import workflow as WF
    from tabflow.spec import SourceSpec
    spec = FeatureSpec(numeric=("x",), categorical=(), target="y", lineage="source", key=("id",))
    path, cache = f"{tmp_dir}/rows", f"{tmp_dir}/stages"
    calls = []
    plain = WF.row_identity
    monkeypatch.setattr(WF, "row_identity", lambda *a: calls.append(1) or plain(*a))

    def rows():
        return WF.combined_rows([(spark.read.parquet(path), SourceSpec(name="one"))], spec, cache).count()

    spark.range(20).selectExpr("id", "id / 2 AS x", "id % 2 AS y").write.parquet(path)
    assert rows() == rows() == 20 and len(calls) == 1
    spark.range(30).selectExpr("id", "id / 2 AS x", "id % 2 AS y").write.mode("overwrite").parquet(path)
    assert rows() == 30 and len(calls) == 2
