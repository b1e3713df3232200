"""Feature building as Spark ML stages: impute + standardise numerics, one-hot categoricals,
pass binaries, assemble one vector. Fitting reads the data in one aggregate per stage; only
means, scales and category lists reach the driver.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.spec import FeatureSpec

log = logging.getLogger("tabflow")

MISSING = "missing"
# Up to this many slots their names are a literal array; beyond, a table joined by position.
LITERAL_SLOTS = 1000


class _ImputeScaleParams(HasInputCols, HasOutputCols):
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted scales", TypeConverters.toListFloat)


class ImputeScale(Estimator, _ImputeScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    """FE1+FE2: mean imputation, then standardisation with the *population* std.

    Spark's ``StandardScaler`` divides by the sample std, so this estimator computes the scale
    itself: after mean imputation the filled rows sit on the mean, so the population std of
    the imputed column is ``stddev_pop(observed) · sqrt(n_observed / n_rows)``. A constant column
    gets scale 1; an all-missing column is dropped (logged), as the original imputer does.
    NaN counts as missing. One aggregate fits every column.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        cols, outs = self.getInputCols(), self.getOutputCols()
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            aggs += [F.avg(x).alias(f"m{i}"), F.count(x).alias(f"c{i}"), F.stddev_pop(x).alias(f"s{i}")]
        r = dataset.agg(*aggs).collect()[0]
        keep_in, keep_out, means, scales = [], [], [], []
        for i, c in enumerate(cols):
            if not r[f"c{i}"]:
                log.warning("numeric column %s has no values; dropped", c)
                continue
            s = (r[f"s{i}"] or 0.0) * math.sqrt(r[f"c{i}"] / r["_n"])
            keep_in.append(c)
            keep_out.append(outs[i])
            means.append(float(r[f"m{i}"]))
            scales.append(s if s > 0 else 1.0)
        m = ImputeScaleModel(inputCols=keep_in, outputCols=keep_out)
        m._set(means=means, scales=scales)
        return m


class ImputeScaleModel(Model, _ImputeScaleParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        for c, o, m, s in zip(self.getInputCols(), self.getOutputCols(),
                              self.getOrDefault(self.means), self.getOrDefault(self.scales)):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            out[o] = F.coalesce((x - F.lit(m)) / F.lit(s), F.lit(0.0))
        return dataset.withColumns(out)


def _prep_sql(spec: FeatureSpec) -> str:
    """FE3/FE5 as one SQL projection: categories to text with 'missing', binaries to 0/1 doubles."""
    parts = ["*"]
    for c in spec.categorical:
        parts.append(f"coalesce(CAST(`{c}` AS STRING), '{MISSING}') AS `_cat_{c}`")
    for c in spec.binary:
        parts.append(f"coalesce(nanvl(try_cast(`{c}` AS DOUBLE), 0D), 0D) AS `_bin_{c}`")
    return "SELECT " + ", ".join(parts) + " FROM __THIS__"


def _post_stages(spec: FeatureSpec, numeric_kept, output_col: str, invalid: str = "error") -> list:
    stages = [SQLTransformer(statement=_prep_sql(spec))]
    oh_out = []
    if spec.categorical:
        idx = [f"_idx_{c}" for c in spec.categorical]
        oh_out = [f"_oh_{c}" for c in spec.categorical]
        stages.append(StringIndexer(inputCols=[f"_cat_{c}" for c in spec.categorical], outputCols=idx,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=oh_out, dropLast=True,
                                    handleInvalid="error"))
    num_out = [f"_num_{c}" for c in numeric_kept]
    bin_out = [f"_bin_{c}" for c in spec.binary]
    stages.append(VectorAssembler(inputCols=num_out + oh_out + bin_out, outputCol=output_col,
                                  handleInvalid=invalid))
    return stages


def build_preprocessor(spec: FeatureSpec, output_col: str = "features") -> Pipeline:
    """FE6: num ‖ cat ‖ bin in one vector; the lineage and target columns never enter it.

    One-hot: categories in alphabetical order, none dropped; an unseen (or NULL) category maps
    to all zeros. ``StringIndexer(handleInvalid='keep')`` adds one index for the unknown and
    ``OneHotEncoder(dropLast=True)`` drops exactly that slot. Use inside a search pipeline (each
    fold refits it); ``fit_preprocessor`` also handles all-missing numeric columns.
    """
    stages = []
    if spec.numeric:
        stages.append(ImputeScale(inputCols=list(spec.numeric),
                                  outputCols=[f"_num_{c}" for c in spec.numeric]))
    return Pipeline(stages=stages + _post_stages(spec, spec.numeric, output_col))


def fit_preprocessor(spec: FeatureSpec, train: DataFrame, output_col: str = "features") -> PipelineModel:
    """FE8: fit on the training rows only; apply the model to train and test alike.

    Any number of categories is accepted: each is a slot of the vector, and the driver holds their
    labels as it holds the coefficients that a model fits for them (the vectors stay sparse).
    The imputer is fitted first so that a numeric column with no values at all is dropped
    from the vector instead of failing the assembler."""
    stages = []
    kept = []
    if spec.numeric:
        imp = ImputeScale(inputCols=list(spec.numeric),
                          outputCols=[f"_num_{c}" for c in spec.numeric]).fit(train)
        stages.append(imp)
        kept = imp.getInputCols()
    rest = Pipeline(stages=_post_stages(spec, kept, output_col)).fit(train)
    return PipelineModel(stages=stages + list(rest.stages))


@dataclass
class FoldFeatures:
    """Preprocessing refitted inside every fold, from one aggregate over all folds.

    Counts, moments and category counts are kept per fold and merged over the folds that a model
    trains on; ``model(f)`` is the preprocessor fitted without fold ``f``, ``model(None)`` the one
    fitted on all rows. ``raw`` gives one vector that serves every fold: numeric slots as they are
    (NaN where missing) and a slot for every category; fold ``f`` sees numeric slot ``j`` as
    ``(x - shifts[f][j]) / scales[f][j]`` (the last row of both is for all rows)."""

    spec: FeatureSpec
    k: int
    numeric: list  # per fold: {column: (rows, values, mean, sum of squared deviations)}
    categories: list  # per fold: {column: set of categories}
    sample: DataFrame

    def _without(self, f: int | tuple | None) -> tuple[dict, dict]:
        """Merged statistics of all folds but ``f`` (one, several, or none)."""
        moments, labels = {}, {}
        out = set(f) if isinstance(f, tuple) else {f}
        for c in self.spec.numeric:
            rows, n, mean, dev = 0, 0, 0.0, 0.0
            for g in range(self.k):
                if g in out or c not in self.numeric[g]:
                    continue
                r, m, mu, d = self.numeric[g][c]
                rows += r
                if m:
                    gap = mu - mean
                    dev += d + gap * gap * n * m / (n + m)
                    mean, n = mean + gap * m / (n + m), n + m
            scale = math.sqrt(dev / rows) if rows else 0.0
            moments[c] = (n, mean, scale if scale > 0 else 1.0)
        for c in self.spec.categorical:
            labels[c] = sorted(set().union(*(self.categories[g].get(c, set()) for g in range(self.k) if g not in out)))
        return moments, labels

    def model(self, f: int | tuple | None, output_col: str = "features") -> PipelineModel:
        made = self.__dict__.setdefault("_made", {})  # many fits ask for the same few folds
        if (f, output_col) not in made:
            made[f, output_col] = self._model(f, output_col)
        return made[f, output_col]

    def _model(self, f: int | tuple | None, output_col: str) -> PipelineModel:
        moments, labels = self._without(f)
        kept = [c for c in self.spec.numeric if moments[c][0]]
        for c in set(self.spec.numeric) - set(kept):
            log.warning("numeric column %s has no values; dropped", c)
        stages = []
        if self.spec.numeric:
            scaler = ImputeScaleModel(inputCols=kept, outputCols=[f"_num_{c}" for c in kept])
            scaler._set(means=[moments[c][1] for c in kept], scales=[moments[c][2] for c in kept])
            stages.append(scaler)
        return PipelineModel(stages=stages + _fitted_post(self.spec, kept, labels, self.sample, output_col))

    def raw(self, df: DataFrame, output_col: str = "features") -> DataFrame:
        _, labels = self._without(None)
        as_is = df.withColumns({f"_num_{c}": F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))
                                for c in self.spec.numeric})
        post = _fitted_post(self.spec, list(self.spec.numeric), labels, self.sample, output_col, "keep")
        return PipelineModel(stages=post).transform(as_is)

    def affine(self) -> tuple[np.ndarray, np.ndarray]:
        _, labels = self._without(None)
        width = len(self.spec.numeric) + sum(map(len, labels.values())) + len(self.spec.binary)
        shifts, scales = np.zeros((self.k + 1, width)), np.ones((self.k + 1, width))
        for f in range(self.k + 1):
            moments, _ = self._without(f if f < self.k else None)
            for j, c in enumerate(self.spec.numeric):
                n, mean, scale = moments[c]
                shifts[f, j], scales[f, j] = mean, scale if n else np.inf  # no values: the slot is always 0
        return shifts, scales


def _fitted_post(spec: FeatureSpec, numeric_kept, labels: dict, sample: DataFrame, output_col: str,
                 invalid: str = "error") -> list:
    """``_post_stages`` with the categories given instead of fitted: no job runs."""
    prep, *rest = _post_stages(spec, numeric_kept, output_col, invalid)
    if not spec.categorical:
        return [prep, *rest]
    indexer, encoder, assembler = rest
    # one model a column: columns of different widths cannot share one that is made from labels
    fitted = [StringIndexerModel.from_labels(labels[c], inputCol=i, outputCol=o, handleInvalid="keep")
              for c, i, o in zip(spec.categorical, indexer.getInputCols(), indexer.getOutputCols(), strict=True)]
    # the encoder's sizes come from the indexers' metadata, not from rows
    return [prep, *fitted, encoder.fit(PipelineModel([prep, *fitted]).transform(sample)), assembler]


def fold_features(spec: FeatureSpec, df: DataFrame, fold_col: str, k: int) -> FoldFeatures:
    """One aggregate: every column's moments or category counts per fold, combined on the map side."""
    entries = []
    for i, c in enumerate(spec.numeric):
        x = F.col(c).cast("double")
        entries.append(F.struct(F.lit(i).alias("at"), F.lit(None).cast("string").alias("category"),
                                F.when(~F.isnan(x), x).alias("x")))
    for j, c in enumerate(spec.categorical):
        entries.append(F.struct(F.lit(len(spec.numeric) + j).alias("at"),
                                F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("category"),
                                F.lit(None).cast("double").alias("x")))
    numeric, categories = [{} for _ in range(k)], [{} for _ in range(k)]
    if entries:
        found = (df.select(F.col(fold_col).cast("int").alias("f"), F.inline(F.array(*entries)))
                 .groupBy("f", "at", "category")
                 .agg(F.count(F.lit(1)).alias("rows"), F.count("x").alias("n"), F.avg("x").alias("mean"),
                      F.var_pop("x").alias("v")).collect())
        for r in found:
            if r["at"] < len(spec.numeric):
                numeric[r["f"]][spec.numeric[r["at"]]] = (r["rows"], r["n"], r["mean"] or 0.0, (r["v"] or 0.0) * r["n"])
            else:
                categories[r["f"]].setdefault(spec.categorical[r["at"] - len(spec.numeric)], set()).add(r["category"])
    return FoldFeatures(spec, k, numeric, categories, df.limit(0))


def slot_names(model: PipelineModel, spec: FeatureSpec) -> list[str]:
    """Names of the vector slots in order: ``col`` for numerics and binaries, ``col_category``
    for one-hot slots (the categories come from the fitted indexer)."""
    names: list[str] = []
    kept_numeric = list(spec.numeric)
    labels_by_col: dict[str, list[str]] = {}
    for st in model.stages:
        if isinstance(st, ImputeScaleModel):
            kept_numeric = list(st.getInputCols())
        if hasattr(st, "labelsArray"):
            columns = st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]
            for c, labels in zip(columns, st.labelsArray):
                labels_by_col[c.removeprefix("_cat_")] = list(labels)
    names += kept_numeric
    for c in spec.categorical:
        names += [f"{c}_{v}" for v in labels_by_col.get(c, [])]
    names += list(spec.binary)
    return names


def features_long(df: DataFrame, names: list[str], id_cols, features: str = "features",
                  nonzero: bool = True) -> DataFrame:
    """The vector as long rows ``(*id, slot, value)``. With ``nonzero`` only the stored entries of a
    sparse vector are ever expanded, so a row costs its non-zero slots, not the vector's width."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    if nonzero:
        v = F.unwrap_udt(features)
        dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("pos"), x.alias("value")))
        stored = F.transform(F.arrays_zip(v["indices"].alias("pos"), v["values"].alias("value")),
                             lambda e: F.struct(e["pos"].alias("pos"), e["value"].alias("value")))
        entries = F.when(v["type"] == 0, stored).otherwise(dense)  # 0: sparse
        out = df.select(*ids, F.inline(entries).alias("_pos", "value")).filter(F.col("value") != 0)
    else:
        out = df.select(*ids, F.posexplode(vector_to_array(features)).alias("_pos", "value"))
    if len(names) <= LITERAL_SLOTS:
        arr = F.array(*[F.lit(n) for n in names])
        return out.select(*ids, F.element_at(arr, F.col("_pos") + 1).alias("slot"), "value")
    table = df.sparkSession.createDataFrame(list(enumerate(names)), "_pos int, slot string")
    return out.join(table, "_pos").select(*ids, "slot", "value")
