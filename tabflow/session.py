"""Spark session helpers.

Everything in the library works on whatever session the caller already has; these helpers only
exist for scripts and tests. On a cluster the master, memory and checkpoint folder come from the
deployment, never from here.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tabflow job relies on. AQE re-plans joins at runtime (a join side that turns
# out small after its shuffle is broadcast then, so no hint ever broadcasts an unchecked side),
# coalesces tiny shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size post-shuffle partitions by bytes (advisory 64 MB), not by a minimum task count: small
    # intermediate tables (bucket totals, fitted-model inputs) collapse to few tasks, big ones
    # still split into many.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tabflow",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for scripts and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint folder). On a
    cluster the deployment names a shared file-system folder there, so a lost executor never takes
    a materialised stage with it; a cluster session without one is an error. Only local masters
    (scripts, tests) get a fallback folder when none is set.
    """
    current = (spark.sparkContext.getCheckpointDir()
               or spark.conf.get("spark.checkpoint.dir", None)
               or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") and fallback is None:
        # a folder on the driver's disk is invisible to executors on other machines
        raise ValueError("set spark.checkpoint.dir to a folder on the shared file system")
    path = fallback or tempfile.mkdtemp(prefix="tabflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
