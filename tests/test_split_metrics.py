"""Splits and metrics: exactness against brute force, independence from partitioning, plans."""

import random

import pytest
from pyspark.sql import functions as F

from tabflow.operators import split as SP
from tabflow.plans import metrics as M


def _frame(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = [(i, 1 if rnd.random() < 0.3 else 0) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label int")


def test_folds_independent_of_partitioning(spark):
    df = _frame(spark)
    a = {r.id: r.fold for r in SP.stratified_folds(df.repartition(3), "label", 5, 42, "id").collect()}
    b = {r.id: r.fold for r in SP.stratified_folds(df.repartition(11, "label"), "label", 5, 42, "id",
                                                  bucket_bits=4).collect()}
    assert a == b


def test_fold_and_split_balance(spark):
    df = _frame(spark)
    f = SP.stratified_folds(df, "label", 5, 42, "id").groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        sizes = [r["count"] for r in f if r.label == lab]
        assert max(sizes) - min(sizes) <= 1
    s = SP.stratified_split(df, "label", 0.2, 42, "id")
    per = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    for lab in (0, 1):
        n = per[(lab, "test")] + per[(lab, "train")]
        assert abs(per[(lab, "test")] - 0.2 * n) <= 0.5


def test_split_plan_has_no_single_partition(spark):
    df = _frame(spark)
    plan = SP.stratified_folds(df, "label", 5, 42, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_sample_n_repeatable(spark):
    df = _frame(spark)
    a = sorted(r.id for r in SP.sample_n(df.repartition(2), 100, 7, "id").collect())
    b = sorted(r.id for r in SP.sample_n(df.repartition(9), 100, 7, "id").collect())
    assert a == b and len(a) == 100


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_match_brute_force(spark):
    rnd = random.Random(5)
    pairs = [(round(rnd.random(), 1), 1 if rnd.random() < 0.4 else 0) for _ in range(600)]
    df = spark.createDataFrame([("m", i, y, s) for i, (s, y) in enumerate(pairs)],
                               "model string, row_id int, label int, score double")
    for b in (2, 16, 1024):
        got = M.roc_auc(df, n_buckets=b).collect()[0].roc_auc
        assert abs(got - _brute_auc(pairs)) < 1e-12


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.3), ("m", 2, 1, 0.5)],
                               "model string, row_id int, label int, score double")
    assert M.roc_auc(df).collect()[0].roc_auc is None


def test_auc_plan_has_no_single_partition_over_rows(spark):
    df = spark.range(0, 1000).select(F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("label"),
                                     (F.col("id") / 1000).alias("score"))
    plan = M.roc_auc(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    # A single-partition exchange may only feed the bucket-totals table (models × buckets rows),
    # here because the constant model column is folded away; never row-level data.
    for i, line in enumerate(plan):
        if "Exchange SinglePartition" in line:
            assert "_bneg" in plan[i + 1], plan[i + 1]


def test_report_with_empty_class(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.9, 1), ("m", 2, 1, 0.8, 1)],
                               "model string, row_id int, label int, score double, prediction int")
    rep = {r.cls: r for r in M.class_report(df).collect()}
    assert rep["class0"].support == 0 and rep["class0"].precision == 0.0
    assert rep["class1"].recall == 1.0 and rep["weighted_avg"].f1 == 1.0
    cm = {(r.label, r.prediction): r.n for r in M.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_flatten_report_names(spark):
    df = spark.createDataFrame([("lr", 1, 1, 0.9, 1), ("lr", 2, 0, 0.2, 1)],
                               "model string, row_id int, label int, score double, prediction int")
    flat = M.flatten_report(M.class_report(df), models=["lr"])
    assert "lr_precision_class1" in flat.columns and "lr_f1_weighted_avg" in flat.columns
    assert flat.collect()[0]["lr_precision_class1"] == 0.5


def test_bucket_count_grows_with_rows():
    from tabflow.functions.ranks import MAX_ROWS_PER_BUCKET, buckets_for
    assert buckets_for(10_000) == 1024
    assert all(n / buckets_for(n) <= MAX_ROWS_PER_BUCKET for n in (10**10, 10**15))


def test_auc_of_counts_beyond_64_bits(spark):
    n = 4 * 10**9
    df = spark.createDataFrame([(0.75 * n * n, n, n)], "num double, p bigint, q bigint")
    assert df.select(M.auc_of(F.col("num"), F.col("p"), F.col("q"))).first()[0] == 0.75


def test_rows_with_one_key_stay_together_and_null_keys_spread(spark):
    rows = [(i // 4, i % 2, i) for i in range(2000)] + [(None, i % 2, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, label int, x int")
    f = SP.stratified_folds(df, "label", 5, 42, "id")
    keyed = f.filter("id is not null").groupBy("label", "id").agg(F.countDistinct("fold").alias("n"))
    assert keyed.filter("n > 1").count() == 0 and f.count() == 4000
    sizes = [r["count"] for r in f.filter("id is null").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 300


def test_folds_shuffle_the_rows_once(spark, tmp_dir):
    _frame(spark, 500).write.parquet(f"{tmp_dir}/rows")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = SP.stratified_folds(spark.read.parquet(f"{tmp_dir}/rows"), "label", 5, 42, "id")
        plan = f._jdf.queryExecution().executedPlan().toString()
        f.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # every exchange is either the rows by (class, bucket), the same twice, or the small offsets
    rows = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "ENSURE_REQUIREMENTS" in x
            and "_bucket" in x]
    assert len(rows) == 2 and len({x.split("plan_id")[0].split("Exchange")[1].split("#")[0] for x in rows}) == 1


def test_evaluate_scores_rows_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def score(x):
        calls.add(1)
        return x / 100.0
    df = spark.range(100).select(F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("label"),
                                 F.udf(score, "double")("id").alias("score"))
    out = M.evaluate(df.withColumn("prediction", (F.col("score") > 0.5).cast("int"))).collect()
    assert calls.value == 100, calls.value
    assert abs(out[0].accuracy - 0.5) <= 0.011


def test_score_columns_gives_each_row_its_own_scores(spark):
    df = spark.createDataFrame([("a", "x#1", 1, 0.9), ("b", "x#1", 1, 0.1), ("b", "x#2", 1, 0.8), ("a", "x#2", 1, 0.2),
                                ("a", "y", 0, 0.5), ("a", "z", None, 0.4)], "model string, row_id string, label int, score double")
    got = sorted((r.row_id, r.label, r.a, r.b) for r in M.score_columns(df, ["a", "b"]).collect())
    assert got == [("x#1", 1, 0.9, 0.1), ("x#2", 1, 0.2, 0.8), ("y", 0, 0.5, None), ("z", None, 0.4, None)]


@pytest.mark.parametrize("rows", [[("a", 1, 1, 0.1), ("a", 1, 1, 0.2)], [("a", 1, 1, 0.1), ("b", 1, 0, 0.2)],
                                  [("a", 1, 1, 0.1), ("b", 1, None, 0.2)]])
def test_score_columns_refuses_ids_of_several_rows(spark, rows):
    df = spark.createDataFrame(rows, "model string, row_id int, label int, score double")
    with pytest.raises(Exception, match="more than one"):
        M.score_columns(df, ["a", "b"]).collect()


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_occurrence_numbers_every_row_once(spark, hot_rows):
    from collections import Counter, defaultdict

    from tabflow.functions.ranks import occurrence
    data = [("hot", i % 40, "same") for i in range(400)] + [("hot", 1, "same")] * 100 + [(f"k{i}", i, None) for i in range(50)]
    data += [(None, 5, "n")] * 6 + [("k1", 1, None)]
    df = spark.createDataFrame(data, "key string, v int, t string").repartition(7)
    got = occurrence(df, "key", "nth", hot_rows).collect()
    assert Counter((r.key, r.v, r.t) for r in got) == Counter(data)
    numbers = defaultdict(list)
    for r in got:
        numbers[r.key].append(r.nth)
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())
    hot = defaultdict(set)
    for r in occurrence(df.repartition(3), "key", "nth", hot_rows).collect():
        hot[r.key, r.v, r.t].add(r.nth)
    again = defaultdict(set)
    for r in got:
        again[r.key, r.v, r.t].add(r.nth)
    assert hot == again  # whatever the partitions


def test_auto_buckets_on_skewed_data(spark, monkeypatch):
    """With a low per-bucket bound, 60k rows take the multi-bucket path automatically; a third
    of the rows share one score value and one quantile value. Results stay exact."""
    import numpy as np

    from tabflow.functions import ranks
    from tabflow.operators import profile as P
    monkeypatch.setattr(ranks, "MAX_ROWS_PER_BUCKET", 5_000)
    monkeypatch.setattr(P, "buckets_for", lambda n, b=1: ranks.buckets_for(n, b))
    rnd = np.random.default_rng(9)
    n = 60_000
    score = np.where(rnd.random(n) < 1 / 3, 0.5, np.round(rnd.random(n), 4))
    label = (rnd.random(n) < 0.2 + 0.6 * score).astype(int)
    df = spark.createDataFrame([("m", i, int(y), float(s)) for i, (y, s) in enumerate(zip(label, score))],
                               "model string, row_id int, label int, score double").persist()
    splits = ranks.approx_splits(df, "model", "score")
    assert len(splits["m"]) > 3  # more than one bucket was chosen
    got = M.roc_auc(df).collect()[0].roc_auc
    # reference: rank formula with average ranks
    order = np.argsort(score, kind="mergesort")
    s_sorted = score[order]
    ranks_avg = np.empty(n)
    i = 0
    while i < n:
        j = i
        while j + 1 < n and s_sorted[j + 1] == s_sorted[i]:
            j += 1
        ranks_avg[order[i:j + 1]] = (i + j) / 2 + 1
        i = j + 1
    P_, N_ = label.sum(), n - label.sum()
    want = (ranks_avg[label == 1].sum() - P_ * (P_ + 1) / 2) / (P_ * N_)
    assert abs(got - want) < 1e-9
    qs, _ = P.exact_quantiles(df.select("score"), ["score"], (0.1, 0.25, 0.5, 0.75, 0.9))
    assert np.allclose(qs["score"], np.quantile(score, [0.1, 0.25, 0.5, 0.75, 0.9]), atol=1e-12)
