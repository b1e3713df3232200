"""The batch operators on a file stream give the same rows as the batch path."""

import orchards as O

from tabflow.operators import clean as C
from tabflow.operators import harmonize as H
from tabflow.sources.io import read_raw
from tabflow.streaming import ingest as S



def test_stream_ingest_matches_batch(spark, tmp_dir):
    north_dir, south_dir, out = f"{tmp_dir}/north", f"{tmp_dir}/south", f"{tmp_dir}/out"
    O.csv(north_dir, "a.csv", O.NORTH_COLS, O.NORTH_ROWS[:2])
    O.csv(north_dir, "b.csv", O.NORTH_COLS, O.NORTH_ROWS[2:])
    O.csv(south_dir, "a.csv", O.SOUTH_COLS, O.SOUTH_ROWS)
    spec, (left, right) = O.spec(), O.sources()
    stream = S.combined_stream([(S.read_raw_stream(spark, north_dir, O.NORTH_COLS, 1), left),
                                (S.read_raw_stream(spark, south_dir, O.SOUTH_COLS, 1), right)], spec)
    q = S.start_ingest(stream, out, name="test_ingest", checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = C.clean(H.combine([(read_raw(spark, north_dir), left), (read_raw(spark, south_dir), right)], spec), spec)
    cols = sorted(batch.columns)
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == \
        sorted(map(tuple, batch.select(cols).collect()), key=str)
    # a second run with the same checkpoint appends nothing new (exactly once)
    q2 = S.start_ingest(S.combined_stream([(S.read_raw_stream(spark, north_dir, O.NORTH_COLS), left),
                                           (S.read_raw_stream(spark, south_dir, O.SOUTH_COLS), right)], spec),
                        out, name="test_ingest2", checkpoint=f"{tmp_dir}/ckpt")
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == 6


def test_score_stream_matches_batch(spark, tmp_dir):
    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F

    from tabflow.plans import features as FE
    from tabflow.plans import train as TR
    spec, (left, right) = O.spec(), O.sources()
    north_dir, south_dir = f"{tmp_dir}/north", f"{tmp_dir}/south"
    O.csv(north_dir, "a.csv", O.NORTH_COLS, O.NORTH_ROWS)
    O.csv(south_dir, "a.csv", O.SOUTH_COLS, O.SOUTH_ROWS)
    batch = C.clean(H.combine([(read_raw(spark, north_dir), left), (read_raw(spark, south_dir), right)], spec), spec) \
        .withColumn("label", F.col("blight").cast("double"))
    pre = FE.fit_preprocessor(spec, batch)
    clf = TR.make_estimator("lr", {"C": 1.0}).fit(pre.transform(batch))
    model = PipelineModel(stages=list(pre.stages) + [clf])
    stream = S.combined_stream([(S.read_raw_stream(spark, north_dir, O.NORTH_COLS), left),
                                (S.read_raw_stream(spark, south_dir, O.SOUTH_COLS), right)], spec)
    scored = S.score_stream(model, stream, ["plot", "source"])
    out = f"{tmp_dir}/scored"
    q = (scored.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{tmp_dir}/ckpt2").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(r.plot, r.source): r.score for r in spark.read.parquet(out).collect()}
    want = {(r.plot, r.source): r.score for r in TR.positive_score(model.transform(batch)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
