"""Features of wide vocabularies: the dictionary of categories is a table, never a list on the driver.

``fit`` gives every distinct category a slot: numerics first, then categories by column and then in code
point order, then binaries, as in the vectors of ``features.fit_preprocessor``. Categories are ranked in
two levels (ranges of sorted categories, running counts of the ranges), so no task sees them all.
``encode`` joins rows to their slots and returns only non-zero entries; an unseen category has none.
NULL is the category 'missing', a numeric column without any value has no slot, an empty table gives an
empty dictionary of categories.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.ranks import prefix_before
from tabflow.plans.features import MISSING, ImputeScale, ImputeScaleModel
from tabflow.sources.io import materialize
from tabflow.spec import FeatureSpec


def _categories(spec: FeatureSpec) -> Column:
    """A row's categories as (position of the column, category), to be exploded by ``inline``."""
    return F.array(*[F.struct(F.lit(i).alias("_at"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("_category"))
                     for i, c in enumerate(spec.categorical)])


@dataclass
class WideFeatures:
    """``slots`` is the dictionary ``(slot long, feature, _at, _category)``; the last two are NULL for
    numerics and binaries."""

    spec: FeatureSpec
    scaler: ImputeScaleModel | None
    slots: DataFrame
    width: int

    def encode(self, df: DataFrame, id_cols) -> DataFrame:
        """``(*id, slot, feature, value)``, one row for every non-zero entry."""
        ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
        kept = list(self.scaler.getInputCols()) if self.scaler else []
        parts = []
        if kept or self.spec.binary:
            scaled = self.scaler.transform(df) if kept else df
            first_binary = self.width - len(self.spec.binary)
            plain = ([(j, c, F.col(f"_num_{c}")) for j, c in enumerate(kept)]
                     + [(first_binary + j, c, F.coalesce(F.nanvl(F.expr(f"try_cast(`{c}` AS DOUBLE)"), F.lit(0.0)), F.lit(0.0)))
                        for j, c in enumerate(self.spec.binary)])
            entries = F.array(*[F.struct(F.lit(j).cast("bigint").alias("slot"), F.lit(c).alias("feature"),
                                         x.cast("double").alias("value")) for j, c, x in plain])
            parts.append(scaled.select(*ids, F.inline(entries)).filter("value <> 0"))
        if self.spec.categorical:
            # a hot category is split by AQE's skew join
            long = df.select(*ids, F.inline(_categories(self.spec)))
            parts.append(long.join(self.slots.filter("_at IS NOT NULL"), ["_at", "_category"])
                         .select(*ids, "slot", "feature", F.lit(1.0).alias("value")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def sparse_rows(long: DataFrame, id_cols) -> DataFrame:
    """``(*id, indices, values)``: a row's entries in slot order. Rows without entries do not appear."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    entries = F.sort_array(F.collect_list(F.struct("slot", "value")))
    return (long.groupBy(*ids).agg(entries.alias("_e"))
            .select(*ids, F.col("_e.slot").alias("indices"), F.col("_e.value").alias("values")))


def fit(spec: FeatureSpec, train: DataFrame) -> WideFeatures:
    """Statistics of the numerics and the dictionary of all categories of ``train``."""
    spark = train.sparkSession
    scaler, kept = None, []
    if spec.numeric:
        scaler = ImputeScale(inputCols=list(spec.numeric), outputCols=[f"_num_{c}" for c in spec.numeric]).fit(train)
        kept = list(scaler.getInputCols())
    shape = "slot bigint, feature string, _at int, _category string"
    n_categories, ranked = 0, spark.createDataFrame([], shape)
    if spec.categorical:
        distinct = train.select(F.inline(_categories(spec))).distinct()
        parts = materialize(distinct.repartitionByRange("_at", "_category")
                            .withColumn("_part", F.spark_partition_id()), "categories")
        counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
        n_categories = int(counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
        offsets = prefix_before(counts.withColumn("_all", F.lit(0)), ["_all"], "_part", "_n", "_before")
        inside = F.row_number().over(Window.partitionBy("_part").orderBy("_at", "_category"))
        names = F.array(*[F.lit(c) for c in spec.categorical])
        ranked = (parts.withColumn("_nth", inside).join(offsets.select("_part", "_before"), "_part")
                  .select((F.coalesce("_before", F.lit(0)) + F.col("_nth") - 1 + len(kept)).cast("bigint").alias("slot"),
                          F.concat(F.element_at(names, F.col("_at") + 1), F.lit("_"), "_category").alias("feature"),
                          "_at", "_category"))
    first_binary = len(kept) + n_categories
    fixed = spark.createDataFrame([(j, c, None, None) for j, c in enumerate(kept)]
                                  + [(first_binary + j, c, None, None) for j, c in enumerate(spec.binary)], shape)
    return WideFeatures(spec, scaler, materialize(ranked.unionByName(fixed), "slots"), first_binary + len(spec.binary))


def linear_contributions(long: DataFrame, weights: DataFrame, n_rows: int, id_cols) -> tuple[DataFrame, DataFrame]:
    """X4 of a wide linear model, without rows x slots: ``(stored, baseline)``.

    ``long`` has the non-zero entries of ``n_rows`` rows, ``weights`` is ``(slot, feature, coef)``.
    ``stored`` ``(*id, feature, contribution)`` has ``coef * (x - mean)`` of every entry, ``baseline``
    ``(feature, contribution, n_stored)`` what each slot gives to every row that has no entry there:
    ``-coef * mean``. Together they are the dense result."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    sums = long.groupBy("slot").agg(F.sum("value").alias("_sum"), F.count("*").alias("n_stored"))
    model = materialize(weights.select("slot", "feature", "coef").join(sums, "slot", "left")
                        .select("slot", "feature", "coef", F.coalesce("n_stored", F.lit(0)).alias("n_stored"),
                                F.coalesce(F.col("_sum") / F.lit(max(n_rows, 1)), F.lit(0.0)).alias("mean")), "slot-means")
    stored = (long.select(*ids, "slot", "value").join(model, "slot")
              .select(*ids, "feature", (F.col("coef") * (F.col("value") - F.col("mean"))).alias("contribution")))
    return stored, model.select("feature", (-F.col("coef") * F.col("mean")).alias("contribution"), "n_stored")


def mean_abs_attribution(stored: DataFrame, baseline: DataFrame, n_rows: int) -> DataFrame:
    """X5 from both parts of ``linear_contributions``: the mean absolute attribution over all rows."""
    sums = stored.groupBy("feature").agg(F.sum(F.abs("contribution")).alias("_sum"))
    rest = (F.lit(n_rows) - F.col("n_stored")) * F.abs("contribution")
    return (baseline.join(sums, "feature", "left")
            .select("feature", ((F.coalesce("_sum", F.lit(0.0)) + rest) / F.lit(max(n_rows, 1))).alias("mean_abs")))


__all__ = ["WideFeatures", "fit", "sparse_rows", "linear_contributions", "mean_abs_attribution"]
