"""Explanations: global importances and coefficients, per-row additive contributions.

Per-row contributions are computed for *all* rows as Spark jobs (the original explained a
1,000-row sample on one machine). Model parameters (coefficients, means, trees) are small and
travel as literals or a broadcast; row data never leaves the executors.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.plans.metrics import top_k


def _model_of(m):
    """The last stage of a PipelineModel, or the model itself."""
    return m.stages[-1] if hasattr(m, "stages") else m


def importances(model, names: list[str], k: int | None = None) -> DataFrame:
    """Tree feature importances with slot names, sorted descending (ties by name)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = _model_of(model).featureImportances.toArray()
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    return top_k(df, "importance", k or len(names), "feature")


def coefficients(model, names: list[str], k: int | None = None) -> DataFrame:
    """Linear coefficients with slot names, sorted by magnitude (P14: |coefficient|)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    m = _model_of(model)
    coef = m.coefficients.toArray()
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, coef)], "feature string, coefficient double")
    df = df.withColumn("abs_coefficient", F.abs("coefficient"))
    return top_k(df, "coefficient", k or len(names), "feature", by_abs=True)


def feature_means(df: DataFrame, features: str = "features") -> list[float]:
    """Background means of every vector slot: one JVM aggregate, a vector to the driver."""
    return [float(x) for x in df.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"]]


def linear_contributions(df: DataFrame, coefs, means, names: list[str], id_cols,
                         features: str | None = "features") -> DataFrame:
    """Exact additive attributions of a linear model on the logit, with independent
    features: ``coef_j · (x_j − mean_j)``; they sum to ``logit(x) − logit(mean)``.

    ``features`` names a vector column; with ``features=None`` the slots are the columns
    ``names`` themselves. Output long ``(*id, feature, contribution)``; coefficients and means
    are literal arrays, so there is no join.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    c_arr = F.array(*[F.lit(float(c)) for c in coefs])
    m_arr = F.array(*[F.lit(float(m)) for m in means])
    n_arr = F.array(*[F.lit(n) for n in names])
    x = vector_to_array(features) if features else F.array(*[F.col(n).cast("double") for n in names])
    zipped = F.arrays_zip(n_arr.alias("feature"), x.alias("x"), c_arr.alias("c"), m_arr.alias("m"))
    return (df.select(*ids, F.inline(zipped))
            .select(*ids, "feature", (F.col("c") * (F.col("x") - F.col("m"))).alias("contribution")))


def mean_abs_attribution(contrib: DataFrame, k: int | None = None) -> DataFrame:
    """Global ranking by mean absolute attribution (partial aggregation per feature)."""
    g = contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    return top_k(g, "mean_abs", k, "feature") if k else g
