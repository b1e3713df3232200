"""Connected components of an undirected graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.sources.io import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): for each node that has an edge the smallest node it can reach.

    Every round takes the least label among a node's neighbours, then the label of that label, so
    long chains shorten fast; each round is written to the shared folder, which cuts the lineage.
    Minima are aggregated before the shuffle, so a node with very many edges is no bottleneck."""
    both = materialize(edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
                       .unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst"))).distinct(),
                       "component-edges")
    labels = both.groupBy(F.col("src").alias("node")).agg(F.min(F.least("src", "dst")).alias("label"))
    labels = materialize(labels.withColumn("moved", F.lit(True)), "component-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("dst"), "label"), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.min("label").alias("_near")))
        step = labels.join(near, "node").select("node", F.col("label").alias("_old"),
                                                F.least("label", "_near").alias("label"))
        step = materialize(step, "component-labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("_far"))
        labels = materialize(step.join(jump, "label").select(
            "node", F.col("_far").alias("label"), (F.col("_far") != F.col("_old")).alias("moved")), "component-labels")
        if labels.filter("moved").isEmpty():
            return labels.select("node", "label")
