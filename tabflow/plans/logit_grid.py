"""All logistic candidates and folds of a search in one pass per iteration.

``fit_grid`` minimises ``Σ loss + ‖w‖²/(2C)`` (``PenalizedLogit``'s objective times ``C·n``, intercept
free) for every pair of a candidate ``C`` and a fold that is left out, by Newton's method. The pairs
share the rows: one job per iteration multiplies each block of rows by all pairs' weights at once and
returns loss, gradient and Hessian of every pair that is still moving, summed by a map-side combined
vector aggregate. A pair whose loss did not fall halves its step and is looked at again in the next
pass, so the whole grid needs as many passes as its slowest pair alone.

With ``shifts`` and ``scales`` (a row a fold) the numeric slots are imputed and standardised inside
each fold: a slot's value for fold ``f`` is ``(x - shift[f]) / scale[f]``, and 0 where it is missing
(NaN). One-hot slots of categories that a fold's training rows lack are zero in all of them, so the
penalty leaves their weights at zero: this equals refitting the preprocessor for every fold.

The driver holds pairs × (slots + 1)² / 2 numbers a pass; ``MAX_SLOTS`` bounds it. Wider vectors are
fitted one by one by ``PenalizedLogit``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots up to which Hessians are formed.
MAX_SLOTS = 256
#: Numbers of a block of rows' products at a time (a row has (slots + 1)² / 2), and its rows at most: with
#: 64 pairs they stay in a core's cache, and a product of so many factors up to 2 is a double.
BLOCK_NUMBERS = 1 << 22
BLOCK_ROWS = 512


@dataclass
class LogitGrid:
    """Weights of every candidate without every fold: ``weights[c, f]`` is (intercept, slots...);
    the last fold's place, ``k``, is the fit on all rows when asked for."""

    Cs: list[float]
    k: int
    weights: np.ndarray
    converged: np.ndarray
    passes: int
    shifts: np.ndarray | None = None
    scales: np.ndarray | None = None


def _design(block: pa.RecordBatch, at: int) -> np.ndarray:
    column = block.column(at)
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _in_fold(x: np.ndarray, f: int, shifts, scales) -> np.ndarray:
    """Rows as fold ``f`` sees them, with a leading 1 for the intercept."""
    z = x if shifts is None else np.nan_to_num((x - shifts[f]) / scales[f], nan=0.0)
    return np.concatenate([np.ones((len(z), 1)), z], axis=1)


def _block_sums(x, y, fold, folds_of, weights, shifts, scales, out) -> None:
    """Add loss, gradient and the Hessian's upper triangle of a block to ``out`` (a row a pair)."""
    d = weights.shape[1]
    upper = np.triu_indices(d)
    groups = sorted(set(folds_of)) if shifts is not None else [None]
    for f in groups:
        pairs = np.flatnonzero(folds_of == f) if f is not None else np.arange(len(folds_of))
        z = _in_fold(x, f, shifts, scales) if f is not None else _in_fold(x, 0, None, None)
        products = z[:, upper[0]] * z[:, upper[1]]
        for lo in range(0, len(pairs), 64):
            part = pairs[lo:lo + 64]
            m = z @ weights[part].T
            seen = fold[:, None] != folds_of[part][None, :]
            # one exponential serves the loss and the probability; the logarithms of 1 + e, which is 2 at
            # most, add up as one of their product
            e = np.exp(-np.abs(m))
            one = 1 + e
            p = np.where(m >= 0, 1, e) / one
            out[part, 0] += (np.where(seen, np.maximum(m, 0) - y[:, None] * m, 0).sum(axis=0)
                             + np.log(np.where(seen, one, 1).prod(axis=0)))
            out[part, 1:1 + d] += (np.where(seen, p - y[:, None], 0).T @ z)
            out[part, 1 + d:] += (np.where(seen, p * (1 - p), 0).T @ products)


def _sums(rows: DataFrame, pairs: np.ndarray, folds_of: np.ndarray, weights: np.ndarray, shifts, scales) -> np.ndarray:
    """One data pass: the sums of every pair in ``pairs``, in their order."""
    d = weights.shape[1]
    width = 1 + d + d * (d + 1) // 2
    step = min(BLOCK_ROWS, max(64, BLOCK_NUMBERS // (d * (d + 1) // 2)))

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(pairs), width))
        for block in blocks:
            x = _design(block, 2)
            y = block.column(1).to_numpy(zero_copy_only=False)
            fold = block.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(y), step):
                _block_sums(x[lo:lo + step], y[lo:lo + step], fold[lo:lo + step], folds_of, weights, shifts, scales, total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["pair", "sums"])

    found = (rows.mapInArrow(run, "pair int, sums array<double>")
             .groupBy("pair").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect())
    by_pair = {r["pair"]: r["sums"].toArray() for r in found}
    return np.array([by_pair.get(int(p), np.zeros(width)) for p in pairs])


def fit_grid(df: DataFrame, Cs: list[float], k: int, fold_col: str = "fold", label: str = "label",
             features: str = "features", shifts: np.ndarray | None = None, scales: np.ndarray | None = None,
             all_rows: bool = False, tol: float = 1e-9, max_passes: int = 100) -> LogitGrid:
    """Fit every candidate of ``Cs`` on the rows outside of every fold 0..k-1 (and on all rows with
    ``all_rows``). A pair has converged when its Newton step is within ``tol`` of its weights."""
    rows = (df.select(F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
                      vector_to_array(features).alias("x")).filter("y IS NOT NULL AND fold IS NOT NULL"))
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        raise ValueError("no labelled rows to fit")
    d = first["d"] + 1
    if d - 1 > MAX_SLOTS:
        raise ValueError(f"{d - 1} slots; Hessians are formed for {MAX_SLOTS} at most")
    folds = k + 1 if all_rows else k
    n = len(Cs) * folds
    folds_of, ridge = np.tile(np.arange(folds), len(Cs)), 1 / np.repeat(np.asarray(Cs, float), folds)
    w, step = np.zeros((n, d)), np.zeros((n, d))
    loss, scale = np.full(n, np.inf), np.zeros(n)
    slope, converged, active = np.zeros(n), np.zeros(n, bool), np.ones(n, bool)
    upper = np.triu_indices(d)
    passes = 0
    while active.any() and passes < max_passes:
        pairs = np.flatnonzero(active)
        trial = w[pairs] + scale[pairs, None] * step[pairs]
        sums = _sums(rows, pairs, folds_of[pairs], trial, shifts, scales)
        passes += 1
        for at, p in enumerate(pairs):
            f = sums[at, 0] + ridge[p] / 2 * (trial[at, 1:] ** 2).sum()
            if not f <= loss[p] + 1e-4 * scale[p] * slope[p] + 1e-12 * abs(loss[p]):
                scale[p] /= 2  # too far: the next pass looks nearer
                if scale[p] < 1e-12:
                    active[p] = False
                continue
            w[p], loss[p] = trial[at], f
            g = sums[at, 1:1 + d].copy()
            g[1:] += ridge[p] * w[p, 1:]
            h = np.zeros((d, d))
            h[upper] = sums[at, 1 + d:]
            h = h + np.triu(h, 1).T + np.diag(np.append(0.0, np.full(d - 1, ridge[p])))
            try:
                step[p] = -np.linalg.solve(h, g)
            except np.linalg.LinAlgError:
                step[p] = -np.linalg.lstsq(h, g, rcond=None)[0]
            scale[p], slope[p] = 1.0, float(g @ step[p])
            if np.abs(step[p]).max() <= tol * (1 + np.abs(w[p]).max()):
                w[p] = w[p] + step[p]
                converged[p], active[p] = True, False
    shape = (len(Cs), folds)
    return LogitGrid(list(Cs), k, w.reshape(*shape, d), converged.reshape(shape), passes, shifts, scales)


def held_out_scores(df: DataFrame, grid: LogitGrid, keep: list[str], fold_col: str = "fold", label: str = "label",
                    features: str = "features", candidates: list[int] | None = None) -> DataFrame:
    """Every row's score by every candidate's fit that did not see its fold, from one pass: long rows
    ``(*keep, label, candidate, fold, score)``."""
    chosen = list(range(len(grid.Cs))) if candidates is None else list(candidates)
    weights, shifts, scales = grid.weights[chosen], grid.shifts, grid.scales
    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kept, "label int", "candidate int", f"`{fold_col}` int", "score double"])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            m = len(keep)
            x, fold = _design(block, m + 2), block.column(m).to_numpy(zero_copy_only=False)
            score = np.zeros((len(fold), len(chosen)))
            for f in np.unique(fold):
                here = fold == f
                z = _in_fold(x[here], f, shifts, scales) if shifts is not None else _in_fold(x[here], 0, None, None)
                score[here] = 1 / (1 + np.exp(-np.clip(z @ weights[:, f].T, -700, 700)))
            again = pa.array(np.repeat(np.arange(len(fold)), len(chosen)))
            cols = [block.column(i).take(again) for i in range(m)] + [block.column(m + 1).take(again)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.tile(np.array(chosen, np.int32), len(fold))), block.column(m).take(again),
                 pa.array(score.ravel())], names=[*keep, "label", "candidate", fold_col, "score"])

    rows = df.select(*keep, F.col(fold_col).cast("int").alias("_fold"), F.col(label).cast("int").alias("_label"),
                     vector_to_array(features).alias("_x")).filter("_label IS NOT NULL AND _fold IS NOT NULL")
    return rows.mapInArrow(run, schema)
