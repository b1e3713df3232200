"""M3: second-order boosted trees with L2 leaf weights for binary labels.

Every round fits one tree to the first and second derivatives of the log-loss at the rows' margins:
``g = p - y``, ``h = p (1 - p)``. A level of the tree is one data pass: tasks add ``g``, ``h`` and the
number of rows up by (node, slot, bin), Spark sums these histograms by node, and the driver, which
sees nothing else, splits every node of the level where

    gain = ½ (G_L²/(H_L+λ) + G_R²/(H_R+λ) - G²/(H+λ)) - γ

is greatest and positive; a leaf weighs ``-step · G/(H+λ)``. Slots are cut at approximate quantiles
into at most ``maxBins`` bins once, before the first round; a missing value (NaN) has a bin of its own
and goes to the side that gains more. Rows are stored with their bins and margins and rewritten every
``REWRITE_ROUNDS`` rounds; between, tasks add up the few trees grown since.

Nothing is sampled, so a fit depends on the rows only, not on their order or partitions (sums of
doubles aside).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasStepSize, Param, Params, TypeConverters)
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.sources.io import materialize

#: Rounds after which the rows are written again with their margins.
REWRITE_ROUNDS = 10
#: Numbers of a level's histograms at most in a task and on the driver; wider levels take several passes.
HISTOGRAM_NUMBERS = 1 << 23


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasMaxIter, HasStepSize):
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest number of tests on a path", TypeConverters.toInt)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf weights", TypeConverters.toFloat)
    minSplitGain = Param(Params._dummy(), "minSplitGain", "gain a split must exceed", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least sum of second derivatives in a child", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins a slot is cut into", TypeConverters.toInt)
    trees = Param(Params._dummy(), "trees", "the fitted trees as JSON", TypeConverters.toString)


class Tree:
    """Nodes as arrays: ``slot`` (-1 for a leaf), ``at`` (x <= at goes left), ``bin`` (its bin), whether
    a missing value goes left, children, leaf ``value``, and ``g``, ``h``, ``n``, ``gain`` of each node."""

    FIELDS = ("slot", "at", "bin", "missing_left", "left", "right", "value", "g", "h", "n", "gain")

    def __init__(self, nodes: list[dict]):
        self.nodes = nodes
        self.slot, self.bin, self.left, self.right = (np.array([n[f] for n in nodes], np.int64)
                                                      for f in ("slot", "bin", "left", "right"))
        self.missing_left = np.array([n["missing_left"] for n in nodes], bool)
        self.at, self.value = (np.array([n[f] for n in nodes], float) for f in ("at", "value"))

    def place(self, x: np.ndarray, binned: bool = False) -> np.ndarray:
        """The node, leaf or not yet split, that each row ends in."""
        node = np.zeros(len(x), np.int64)
        live = np.flatnonzero(self.slot[node] >= 0)
        while len(live):
            here = node[live]
            v = x[live, self.slot[here]]
            gone = v == 0 if binned else np.isnan(v)
            low = v <= self.bin[here] if binned else v <= self.at[here]
            node[live] = np.where(np.where(gone, self.missing_left[here], low), self.left[here], self.right[here])
            live = live[self.slot[node[live]] >= 0]
        return node


def _margins(x: np.ndarray, base: float, trees: list[Tree]) -> np.ndarray:
    out = np.full(len(x), base)
    for t in trees:
        out += t.value[t.place(x)]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


class SecondOrderTrees(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """The estimator; parameters follow the original workflow's defaults (depth 6, step 0.1, λ 1)."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 rawPredictionCol="rawPrediction", maxIter=100, stepSize=0.1, maxDepth=6, regLambda=1.0,
                 minSplitGain=0.0, minChildWeight=1.0, maxBins=256):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.1, maxDepth=6, regLambda=1.0, minSplitGain=0.0, minChildWeight=1.0, maxBins=256)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SecondOrderTreesModel":
        p = {q.name: self.getOrDefault(q) for q in self.params if self.isDefined(q)}
        rows = (dataset.select(F.col(p["labelCol"]).cast("double").alias("y"), vector_to_array(p["featuresCol"]).alias("x"))
                .filter("y IS NOT NULL"))
        width, cuts, mean = _cuts(rows, p["maxBins"])
        base = math.log(mean / (1 - mean)) if 0 < mean < 1 else (-30.0 if mean <= 0 else 30.0)
        held = materialize(_binned(rows, cuts, base), "boost-rows")
        trees: list[Tree] = []
        pending: list[Tree] = []
        losses: list[float] = []
        for _ in range(p["maxIter"]):
            tree, loss = _grow(held, pending, width, cuts, p)
            losses.append(loss)
            trees.append(tree)
            pending.append(tree)
            if len(pending) == REWRITE_ROUNDS:
                held, pending = materialize(_moved(held, pending), "boost-rows"), []
        model = SecondOrderTreesModel()
        copied = {q: self.getOrDefault(q) for q in self.params if self.isDefined(q)}
        for q, v in copied.items():
            model._set(**{q.name: v})
        model._set(trees=json.dumps({"base": base, "width": width, "losses": losses,
                                     "trees": [[[n[f] for f in Tree.FIELDS] for n in t.nodes] for t in trees]}))
        return model


def _cuts(rows: DataFrame, bins: int) -> tuple[int, list[np.ndarray], float]:
    """(slots, cut points of each slot, share of positive labels), from two aggregates. A slot with few
    distinct values is cut at each of them."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        raise ValueError("no labelled rows to fit")
    d = first["d"]
    probs = [i / bins for i in range(1, bins)]
    cuts: list[np.ndarray] = []
    for lo in range(0, d, 64):  # the sketches of 64 slots at a time
        found = rows.agg(F.avg("y").alias("mean"), *[
            F.percentile_approx(F.when(~F.isnan(F.col("x")[j]), F.col("x")[j]), probs, 4 * bins).alias(f"q{j}")
            for j in range(lo, min(d, lo + 64))]).first()
        cuts += [np.unique(np.array(found[f"q{j}"] or [], float)) for j in range(lo, min(d, lo + 64))]
    return d, cuts, float(found["mean"])


def _binned(rows: DataFrame, cuts: list[np.ndarray], base: float) -> DataFrame:
    """Rows as (y, margin, bins): bin 0 is missing, bin b > 0 holds what is above cut b - 2 and up to cut b - 1."""
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            x = _matrix(block.column(1))
            out = np.zeros(x.shape, np.int16)
            for j, c in enumerate(cuts if len(x) else []):
                out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(c, x[:, j], "left") + 1)
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(np.full(len(x), base)),
                 pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(cuts)).cast(pa.list_(pa.int16()))],
                names=["y", "margin", "bins"])

    return rows.mapInArrow(run, "y double, margin double, bins array<smallint>")


def _moved(held: DataFrame, trees: list[Tree]) -> DataFrame:
    """The rows with the trees' values added to their margins."""
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            margin = block.column(1).to_numpy().copy()
            bins = _matrix(block.column(2))
            for t in trees if len(margin) else []:
                margin += t.value[t.place(bins, True)]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(margin), block.column(2)], names=["y", "margin", "bins"])

    return held.mapInArrow(run, held.schema)


def _histograms(held: DataFrame, trees: list[Tree], tree: Tree, nodes: list[int], width: int, most: int) -> dict[int, np.ndarray]:
    """Sums of g, h and rows by node, slot and bin (and the loss, in one more number) of one pass."""
    local = {n: i for i, n in enumerate(nodes)}
    size = width * most

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(nodes), 3 * size + 1))
        of = np.full(len(tree.nodes), -1)
        for n, i in local.items():
            of[n] = i
        for block in blocks:
            y, margin, bins = block.column(0).to_numpy(), block.column(1).to_numpy().copy(), _matrix(block.column(2))
            if not len(y):
                continue
            for t in trees:
                margin += t.value[t.place(bins, True)]
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            node = of[tree.place(bins, True)]
            inside = node >= 0
            loss = np.maximum(margin, 0) - y * margin + np.log1p(np.exp(-np.abs(margin)))
            np.add.at(total[:, -1], node[inside], loss[inside])
            cell = ((node[inside, None] * width + np.arange(width)) * most + bins[inside]).ravel()
            g, h = (p - y)[inside], (p * (1 - p))[inside]
            for k, v in enumerate((g, h, np.ones(len(g)))):
                sums = np.bincount(cell, np.repeat(v, width), len(nodes) * size)
                total[:, k * size:(k + 1) * size] += sums.reshape(len(nodes), size)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["node", "sums"])

    found = (held.mapInArrow(run, "node int, sums array<double>")
             .groupBy("node").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect())
    return {r["node"]: r["sums"].toArray() for r in found}


def _grow(held: DataFrame, trees: list[Tree], width: int, cuts: list[np.ndarray], p: dict) -> tuple[Tree, float]:
    """One tree, level by level, and the mean loss before it."""
    most = max((len(c) for c in cuts), default=0) + 2
    nodes = [_node()]
    level, loss, rows = [0], 0.0, 0.0
    for depth in range(p["maxDepth"] + 1):
        tree = Tree(nodes)
        held_at = {}
        step = max(1, HISTOGRAM_NUMBERS // (3 * width * most + 1))
        for lo in range(0, len(level), step):
            held_at |= _histograms(held, trees, tree, level[lo:lo + step], width, most)
        nxt = []
        for n in level:
            sums = held_at.get(n)
            if sums is None:
                continue
            g, h, c = sums[:-1].reshape(3, width, most)
            if depth == 0:
                loss, rows = sums[-1], c[0].sum()
            node = nodes[n]
            node["g"], node["h"], node["n"] = float(g[0].sum()), float(h[0].sum()), float(c[0].sum())
            node["value"] = -p["stepSize"] * node["g"] / (node["h"] + p["regLambda"])
            best = _best_split(g, h, p) if depth < p["maxDepth"] and node["n"] > 1 else None
            if best is None:
                continue
            node["gain"], j, b, missing_left = best
            # the last bin holds all that is above the last cut: then only missing values go right
            at = -math.inf if b == 0 else float(cuts[j][b - 1]) if b <= len(cuts[j]) else math.inf
            node |= {"slot": j, "bin": b, "at": at, "missing_left": missing_left,
                     "left": len(nodes), "right": len(nodes) + 1}
            nodes += [_node(), _node()]
            nxt += [node["left"], node["right"]]
        level = nxt
        if not level:
            break
    return Tree(nodes), loss / max(rows, 1)


def _node() -> dict:
    return {"slot": -1, "at": 0.0, "bin": 0, "missing_left": False, "left": -1, "right": -1, "value": 0.0,
            "g": 0.0, "h": 0.0, "n": 0.0, "gain": 0.0}


def _best_split(g: np.ndarray, h: np.ndarray, p: dict):
    """(gain, slot, last bin on the left, whether missing goes left); of equal gains the first slot and
    cut, missing values to the right. None where nothing gains."""
    lam, least = p["regLambda"], p["minChildWeight"]
    total_g, total_h = g[0].sum(), h[0].sum()
    best = None
    gs, hs = np.cumsum(g[:, 1:], axis=1), np.cumsum(h[:, 1:], axis=1)
    # a cut after bin b = 0 parts the missing from all others, so it is looked at with missing on the left only
    gs, hs = (np.concatenate([np.zeros((len(g), 1)), s], axis=1) for s in (gs, hs))
    for missing_left in (False, True):
        left_g, left_h = (gs + g[:, :1], hs + h[:, :1]) if missing_left else (gs, hs)
        right_g, right_h = total_g - left_g, total_h - left_h
        ok = (left_h >= least) & (right_h >= least)
        gain = 0.5 * (left_g ** 2 / (left_h + lam) + right_g ** 2 / (right_h + lam) - total_g ** 2 / (total_h + lam)) - p["minSplitGain"]
        gain = np.where(ok, gain, -np.inf)
        j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[j, b] > 1e-12 and (best is None or gain[j, b] > best[0] * (1 + 1e-12)):
            best = (float(gain[j, b]), int(j), int(b), missing_left)
    return best


class SecondOrderTreesModel(Model, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted trees: margins, probabilities, importances by gain, and a table of the nodes."""

    def __init__(self):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.1, maxDepth=6, regLambda=1.0, minSplitGain=0.0, minChildWeight=1.0, maxBins=256)

    def _spec(self) -> dict:
        held = self.getOrDefault(self.trees)
        if getattr(self, "_parsed", (None,))[0] is not held:
            spec = json.loads(held)
            spec["trees"] = [Tree([dict(zip(Tree.FIELDS, n, strict=True)) for n in t]) for t in spec["trees"]]
            self._parsed = (held, spec)
        return self._parsed[1]

    def copy(self, extra=None):
        out = super().copy(extra)
        out.__dict__.pop("_parsed", None)
        return out

    @property
    def base(self) -> float:
        return self._spec()["base"]

    @property
    def losses(self) -> list[float]:
        """Mean training log-loss before each round."""
        return self._spec()["losses"]

    @property
    def featureImportances(self) -> DenseVector:
        """Each slot's share of the gain of all splits."""
        spec = self._spec()
        gains = np.zeros(spec["width"])
        for t in spec["trees"]:
            for n in t.nodes:
                if n["slot"] >= 0:
                    gains[n["slot"]] += n["gain"]
        return DenseVector(gains / gains.sum() if gains.sum() > 0 else gains)

    def node_table(self, spark) -> DataFrame:
        """One row a node: (tree, node, slot, at, missing_left, left, right, value, g, h, n, gain)."""
        rows = [(k, i, int(n["slot"]), float(n["at"]), bool(n["missing_left"]), int(n["left"]), int(n["right"]),
                 float(n["value"]), float(n["g"]), float(n["h"]), int(n["n"]), float(n["gain"]))
                for k, t in enumerate(self._spec()["trees"]) for i, n in enumerate(t.nodes)]
        return spark.createDataFrame(rows, "tree int, node int, slot int, at double, missing_left boolean, left int, right int, "
                                           "value double, g double, h double, n long, gain double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spec = self._spec()
        base, trees = spec["base"], spec["trees"]

        def margins(x: pd.Series) -> pd.Series:
            return pd.Series(_margins(np.stack(x.to_numpy()).astype(float), base, trees) if len(x) else np.zeros(0))

        margin = F.pandas_udf(margins, "double")(vector_to_array(self.getFeaturesCol()))
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return (dataset.withColumn("_margin", margin)
                .withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))))
                .withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - p, p)))
                .withColumn(self.getPredictionCol(), (F.col("_margin") > 0).cast("double")).drop("_margin"))
