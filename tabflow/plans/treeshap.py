"""Exact per-row additive attributions of tree ensembles (path-dependent Shapley values).

For one leaf with value ``v`` whose path tests the distinct features ``U`` (``d`` of them), let
``s_j(x)`` be 1 when ``x`` satisfies every test on feature ``j`` along the path and ``z_j`` the
fraction of training cover that follows those tests. The path-dependent expectation of the
tree given known features ``S`` is ``Σ_leaves v · Π_{j∈U} (s_j if j∈S else z_j)``, a sum of
product games, so the Shapley value of ``i ∈ U`` from that leaf is

    v · (s_i − z_i) · Σ_k w(k) · [t^k] Π_{j∈U, j≠i} (z_j + s_j·t),   w(k) = k!(d−k−1)!/d!

It depends on a row only through the pattern of the ``s_j``. A block of rows therefore reduces to
the patterns it has at a leaf: the values of each pattern are computed once, in a table, and rows
look theirs up. Attributions sum to ``f(x) − E[f]`` exactly; ``f`` is the class-1 probability for a
random forest and the margin for boosted trees.

The forest stays a DataFrame of nodes (``node_table``): trees are dealt into groups of about
``GROUP_NODES`` nodes, rows into blocks, and every (tree group, share of the row blocks) is a task that
reads the group's nodes and then its blocks one after the other. The rows are read once, no node
passes through the driver, and a task holds one group and one block whatever the size of either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.plans.boost import SecondOrderTreesModel
from tabflow.sources.io import materialize, run_path

#: Nodes of the trees that one task holds (one tree at least, whose size the model's depth bounds).
GROUP_NODES = 200_000
#: Rows of a block, and blocks that one task meets with its trees.
BLOCK_ROWS = 4096
BLOCKS_PER_TASK = 16

_NODES = ("tree int, node int, slot int, at double, cats array<double>, missing_left boolean, left int, right int, "
          "cover double, value double")


def _inner(model):
    return model.stages[-1] if hasattr(model, "stages") else model


def node_table(model, spark) -> DataFrame:
    """One row a node (tree, node, slot, at, cats, missing_left, left, right, cover, value): ``slot`` is -1
    for a leaf, ``cats`` the categories that go left (null for a threshold ``at``), ``value`` a leaf's
    share of the ensemble's output, ``cover`` the training weight that reached the node."""
    m = _inner(model)
    names = [c.split()[0] for c in _NODES.split(", ")]
    if isinstance(m, SecondOrderTreesModel):
        return (m.node_table(spark).withColumn("cats", F.lit(None).cast("array<double>")).withColumn("cover", F.col("h"))
                .select(*names))
    path = run_path(spark, f"trees-{m.uid}")
    m.write().overwrite().save(path)
    forest = not type(m).__name__.startswith("GBT")
    weights = F.array(*[F.lit(float(w) / (len(m.treeWeights) if forest else 1)) for w in m.treeWeights])
    stats = F.col("nodeData.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    share = F.when((total > 0) & (F.size(stats) > 1), stats[1] / total).otherwise(F.lit(0.0))
    split, leaf = F.col("nodeData.split"), F.col("nodeData.leftChild") < 0
    by_category = split["numCategories"] > 0
    values = split["leftCategoriesOrThreshold"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(leaf, F.lit(-1)).otherwise(split["featureIndex"]).alias("slot"),
        F.when(~leaf & ~by_category, values[0]).alias("at"), F.when(~leaf & by_category, values).alias("cats"),
        F.lit(False).alias("missing_left"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.rawCount").cast("double").alias("cover"),
        ((share if forest else F.col("nodeData.prediction")) * F.element_at(weights, F.col("treeID") + 1)).alias("value"))


def expected_value(model, spark) -> float:
    """``E[f]`` under the training cover: the value the attributions are measured from."""
    nodes = node_table(model, spark)
    roots = nodes.groupBy("tree").agg(F.min_by("cover", "node").alias("_all"))
    leaves = nodes.filter("slot < 0").join(roots, "tree")
    found = leaves.agg(F.sum(F.when(F.col("_all") > 0, F.col("value") * F.col("cover") / F.col("_all"))).alias("e")).first()["e"]
    m = _inner(model)
    return (found or 0.0) + (m.base if isinstance(m, SecondOrderTreesModel) else 0.0)


# In a task ------------------------------------------------------------------------------------------

def unfold(nodes: dict) -> list:
    """The leaves of one tree, given as {node: row}: (value, features on the path, their cover fractions,
    tests as (place of the feature, feature, at, cats, missing_left, whether the path goes left))."""
    leaves, stack = [], [(min(nodes), [])]
    while stack:
        at, path = stack.pop()
        nd = nodes[at]
        if nd["slot"] < 0:
            by_feature: dict[int, list] = {}
            for test in path:
                by_feature.setdefault(test[0], []).append(test)
            U = sorted(by_feature)
            z = np.array([math.prod(t[5] for t in by_feature[f]) for f in U], float)
            leaves.append((nd["value"], U, z, [(u, *t[:5]) for u, f in enumerate(U) for t in by_feature[f]]))
            continue
        for child, left in ((nd["left"], True), (nd["right"], False)):
            part = nodes[child]["cover"] / nd["cover"] if nd["cover"] else 0.0
            stack.append((child, [*path, (nd["slot"], nd["at"], nd["cats"], nd["missing_left"], left, part)]))
    return leaves


def _shapley_weights(d: int) -> np.ndarray:
    return np.array([math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)])


def pattern_values(s: np.ndarray, z: np.ndarray, v: float) -> np.ndarray:
    """The values of a leaf for each pattern (patterns × features, true where a feature's tests hold)."""
    n, d = s.shape
    a = s.astype(float)
    whole = np.zeros((n, d + 1))
    whole[:, 0] = 1.0
    for j in range(d):
        nxt = whole * z[j]
        nxt[:, 1:] += whole[:, :-1] * a[:, j:j + 1]
        whole = nxt
    w, out = _shapley_weights(d), np.empty((n, d))
    for i in range(d):  # divide the factor of i out of the product
        zero = whole[:, :d] / z[i] if z[i] > 0 else np.zeros((n, d))
        one = np.empty((n, d))
        one[:, d - 1] = whole[:, d]
        for k in range(d - 1, 0, -1):
            one[:, k - 1] = whole[:, k] - z[i] * one[:, k]
        out[:, i] = v * (a[:, i] - z[i]) * (np.where(s[:, i:i + 1], one, zero) @ w)
    return out


def attributions(X: np.ndarray, trees: list, n_features: int) -> np.ndarray:
    """Exact path-dependent Shapley values of a block ``X`` (rows × features), given unfolded trees."""
    n = len(X)
    phi = np.zeros((n_features, n))
    columns = np.ascontiguousarray(X.T)
    for leaves in trees:
        known: dict = {}  # the tests of a tree, each evaluated once
        for v, U, z, tests in leaves:
            d = len(U)
            if d == 0 or v == 0.0:
                continue
            holds: list = [None] * d
            for u, f, at, cats, missing_left, left in tests:
                key = (f, at, None if cats is None else tuple(cats), missing_left)
                if key not in known:
                    x = columns[f]
                    known[key] = np.isin(x, cats) if cats is not None else np.where(np.isnan(x), missing_left, x <= at)
                c = known[key] if left else ~known[key]
                holds[u] = c if holds[u] is None else holds[u] & c
            if d <= 16:  # patterns by their number
                code = np.zeros(n, np.int64)
                for u in range(d):
                    code |= holds[u].astype(np.int64) << u
                present = np.flatnonzero(np.bincount(code, minlength=1 << d))
                place = np.zeros(1 << d, np.int64)
                place[present] = np.arange(len(present))
                patterns, at_row = (present[:, None] >> np.arange(d)) & 1 == 1, place[code]
            else:
                patterns, at_row = np.unique(np.stack(holds, axis=1), axis=0, return_inverse=True)
            values = pattern_values(patterns, z, v)
            for u in range(d):
                phi[U[u]] += values[at_row, u]
    return phi.T


# On Spark -------------------------------------------------------------------------------------------

def _blocks(df: DataFrame, id_col: str, features: str) -> DataFrame:
    """Rows as (block, id, x), blocks numbered within their partition."""
    rows = df.select(F.col(id_col).alias("id"), vector_to_array(features).alias("x"))
    id_type = rows.schema["id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, at)), *part.columns], names=["block", "id", "x"])
                at += 1

    return rows.mapInArrow(number, f"block bigint, id {id_type}, x array<double>")


def tree_contributions(model, df: DataFrame, names: list[str], id_col: str = "row_id",
                       features: str = "features") -> DataFrame:
    """X3 over every row: long ``(row_id, feature, contribution)`` for non-zero attributions."""
    spark = df.sparkSession
    nodes = materialize(node_table(model, spark), "tree-nodes")
    counts = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("tree").alias("last")).first()
    trees, groups = (counts["last"] or 0) + 1, max(1, -(-counts["n"] // GROUP_NODES))
    groups = min(groups, trees)
    rows = materialize(_blocks(df, id_col, features), "tree-rows")
    shares = max(1, -(-rows.select("block").distinct().count() // BLOCKS_PER_TASK))
    id_type = rows.schema["id"].dataType.simpleString()

    every_share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    tree_cols = [c.split()[0] for c in _NODES.split(", ")]
    left = (nodes.withColumn("grp", F.floor(F.col("tree") * groups / trees).cast("int")).withColumn("share", every_share)
            .select("grp", "share", F.lit(-1).cast("bigint").alias("block"), *tree_cols,
                    F.lit(None).cast(id_type).alias("id"), F.lit(None).cast("array<double>").alias("x")))
    right = (rows.withColumn("grp", every_group)
             .select("grp", F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int").alias("share"), "block",
                     *[F.lit(None).cast(c.split(maxsplit=1)[1]).alias(c.split()[0]) for c in _NODES.split(", ")], "id", "x"))
    name_arr, n_features = np.array(names, dtype=object), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, by_tree, forest = None, {}, None
        for batch in batches:
            key = np.array([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            cuts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if batch.num_rows else []
            for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows]):
                grp, share, block = key[:, lo].tolist()
                if (grp, share) != at:
                    at, by_tree, forest = (grp, share), {}, None
                part = batch.slice(lo, hi - lo)
                if block < 0:
                    for row in part.select(tree_cols).to_pylist():
                        by_tree.setdefault(row["tree"], {})[row["node"]] = row
                    continue
                if forest is None:
                    forest, by_tree = [unfold(t) for t in by_tree.values()], {}
                ids, x = part.column("id"), part.column("x")
                phi = attributions(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), forest, n_features)
                r, c = np.nonzero(phi)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(r)), pa.array(name_arr[c], pa.string()), pa.array(phi[r, c])],
                                                 names=[id_col, "feature", "contribution"])

    out = (left.unionByName(right).repartition("grp", "share").sortWithinPartitions("grp", "share", "block")
           .mapInArrow(run, f"`{id_col}` {id_type}, feature string, contribution double"))
    if groups == 1:
        return out
    return out.groupBy(id_col, "feature").agg(F.sum("contribution").alias("contribution"))


__all__ = ["tree_contributions", "expected_value", "attributions", "node_table", "unfold"]
