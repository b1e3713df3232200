"""The whole analysis as one call: harmonise → clean → profile → split → features → search →
evaluate → stack → cross-validate → explain → record.

Row-level data stays in Spark throughout; the frames that several stages reuse (the split
frame, the featurised train set) are materialised once in the shared checkpoint folder, which
also cuts their lineage so a lost executor recomputes from there, not from the raw sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.functions.ranks import HOT_ROWS, occurrence
from tabflow.operators import clean as C
from tabflow.operators import harmonize as H
from tabflow.operators import profile as P
from tabflow.operators import split as SP
from tabflow.plans import ensemble as EN
from tabflow.plans import explain as X
from tabflow.plans import features as FE
from tabflow.plans import metrics as M
from tabflow.plans import runlog as RL
from tabflow.plans import train as TR
from tabflow.plans import treeshap as TS
from tabflow.session import checkpoint_dir
from tabflow.sources.io import cached, fingerprint, materialize, save_model, write_table
from tabflow.spec import FeatureSpec, GridSpec, SourceSpec, StackSpec

# The preset search grids of the original modular workflow.
DEFAULT_GRIDS = (
    GridSpec("lr", {"C": [0.0001, 0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0, 20000.0, 50000.0]},
             n_iter=20),
    GridSpec("rf", {"n_estimators": [100, 200, 300], "max_depth": [5, 10, 15],
                    "min_samples_split": [2], "min_samples_leaf": [1]}, n_iter=20),
    GridSpec("gbt", {"n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.1, 0.2]}, n_iter=20),
)


TUNED = ("C", "numTrees", "maxDepth", "minInstancesPerNode", "maxIter", "stepSize")


@dataclass
class RunResult:
    combined: DataFrame
    profiles: dict
    search_results: DataFrame
    metrics: DataFrame
    report: DataFrame
    cv: DataFrame
    explanations: dict
    record: DataFrame
    models: dict = field(default_factory=dict)


def row_identity(df: DataFrame, spec: FeatureSpec, out: str = "row_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """A row's identity: its source, its key and its occurrence among rows that share both, written so
    that no two can be confused. Rows with a NULL in the key are told apart by their content; of rows
    that agree in everything the numbering is arbitrary. A key with any share of the rows is numbered
    in many tasks (``ranks.occurrence``)."""
    parts = ([spec.lineage] if spec.lineage else []) + list(spec.key)
    unkeyed = F.exists(F.array(*[F.col(c).isNull() for c in spec.key]), lambda x: x)
    content = F.when(unkeyed, F.xxhash64(*df.columns)).otherwise(F.lit(0))
    name = F.to_json(F.struct(*parts, content.alias("_content")), {"ignoreNullFields": "false"})
    return (occurrence(df.withColumn("_name", name), "_name", "_nth", hot_rows)
            .withColumn(out, F.concat_ws("#", "_name", F.col("_nth").cast("string"))).drop("_name", "_nth"))


def combined_rows(sources: list[tuple[DataFrame, SourceSpec]], spec: FeatureSpec, cache_dir: str | None = None) -> DataFrame:
    """The harmonised, cleaned rows of all sources with ``row_id`` and ``label``. With ``cache_dir`` they are
    stored there by a fingerprint of the plan, the specification and the input files: as long as none of
    them changes, a later run reads the stored rows and does no work on the sources."""
    cleaned = C.clean(H.combine(sources, spec), spec)

    def identified() -> DataFrame:
        return row_identity(cleaned, spec).withColumn("label", F.col(spec.target).cast("double"))

    if cache_dir is None:
        return identified()
    return cached(cleaned.sparkSession, cache_dir, fingerprint(cleaned, repr(spec)), identified)


def run(spark: SparkSession, sources: list[tuple[DataFrame, SourceSpec]], spec: FeatureSpec,
        grids=DEFAULT_GRIDS, k: int = 5, test_frac: float = 0.2, seed: int = 42,
        stack: StackSpec | None = StackSpec(), out_dir: str | None = None, profile: bool = True,
        parallelism: int = 4, mode: str = "local", cache_dir: str | None = None) -> RunResult:
    if not spec.key:
        raise ValueError("FeatureSpec.key is required: splits and folds are placed by key hash")
    timer = RL.StageTimer()
    checkpoint_dir(spark)
    # rows of two sources may share a key; a row's place depends on both
    key = ([spec.lineage] if spec.lineage else []) + list(spec.key)

    with timer.stage("combine"):
        combined = combined_rows(sources, spec, cache_dir)
        # The combined table is written once (partitioned by source when an output folder is
        # given); profiling and splitting read it instead of re-deriving it from the sources
        if out_dir:
            write_table(combined, f"{out_dir.rstrip('/')}/combined")
            combined = spark.read.parquet(f"{out_dir.rstrip('/')}/combined")
        elif cache_dir is None:
            combined = materialize(combined, "combined")
    profiles = {}
    if profile:
        with timer.stage("profile"):
            profiles = P.profile(combined, spec.numeric, spec.categorical)
            profiles["target"] = P.value_counts(combined, spec.target)
            profiles["dropped"] = C.dropped_counts(H.combine(sources, spec), spec.target, spec.lineage)
            profiles["total_nulls"] = P.total_nulls(combined, list(spec.features))
            profiles["schema"] = P.schema_info(combined)
            profiles["head"] = P.head_n(combined, 5, key)

    with timer.stage("split"):
        split = SP.stratified_split(combined, "label", test_frac, seed, key)
        split = materialize(split, "split")
        train = split.filter(F.col("split") == "train")
        test = split.filter(F.col("split") == "test")

    with timer.stage("features"):
        # statistics of every fold at once: the search preprocesses inside its folds, and all rows'
        # statistics are their sum
        train = materialize(SP.stratified_folds(train, "label", k, seed, key), "train-rows")
        folds = FE.fold_features(spec, train, "fold", k)
        pre = folds.model(None)
        names = FE.slot_names(pre, spec)
        train_x = materialize(pre.transform(train).select("row_id", "label", "features", "fold"), "train")
        test_x = materialize(pre.transform(test).select("row_id", "label", "features"), "test")

    models, best_est, results, scores, metas = {}, {}, [], [], {}
    stacked_names: list[str] = []
    params: dict[str, str] = {}
    chosen: dict[str, dict] = {}
    with timer.stage("search"):
        oof = {}
        for g in grids:
            sr = TR.search(g.model, train_x, g.grid, k, n_iter=g.n_iter, seed=g.seed,
                           parallelism=parallelism, folds=folds, raw=train)
            best, est = sr.best_model, sr.best_estimator
            models[g.model], best_est[g.model], oof[g.model] = best, est, sr.oof
            results.append(sr.results)
            chosen[g.model] = {p.name: v for p, v in est.extractParamMap().items() if p.name in TUNED}
            params[f"{g.model}_best_params"] = str(chosen[g.model])
            scores.append(TR.predict(best, test_x, ["row_id"], name=g.model))
            scores.append(TR.predict(best, train_x.drop("fold"), ["row_id"], name=f"{g.model}_train"))
    search_results = results[0]
    for r in results[1:]:
        search_results = search_results.unionByName(r)

    if stack is not None:
        names_in = [n for n in models if n in stack.base]
        if len(names_in) >= 2:
            with timer.stage("stack"):
                if stack.mode == "full":
                    # out-of-fold scores come from the search's held-out predictions and the base
                    # models are the searched refits: only the meta model is fitted here
                    oof_long = oof[names_in[0]]
                    for n in names_in[1:]:
                        oof_long = oof_long.unionByName(oof[n])
                    meta = EN.fit_stack(oof_long.drop("fold"), names_in, stack.meta_C)
                    stacked = EN.stacked_scores(meta, {n: models[n] for n in names_in}, test_x)
                    metas["stacked"] = meta
                else:
                    metas["stacked"], _, stacked = EN.run_stack({n: best_est[n] for n in names_in}, train_x, test_x,
                                                 k, C=stack.meta_C, mode=stack.mode)
                scores.append(stacked)
                stacked_names = names_in

    all_scores = scores[0]
    for s in scores[1:]:
        all_scores = all_scores.unionByName(s)
    with timer.stage("evaluate"):
        # every model scores its rows once; metrics and report read the stored scores
        all_scores = materialize(all_scores, "scores")
        metrics = M.evaluate(all_scores).cache()
        report = M.class_report(all_scores).cache()
        metrics.count()
        report.count()

    # M7: the chosen models cross-validated over all labelled rows, train and test, in new folds;
    # the stack with everything inside the fold
    with timer.stage("final_cv"):
        every = SP.stratified_folds(split.drop("split"), "label", k, seed + 1, "row_id")
        every = materialize(every, "final-cv")
        every_folds = FE.fold_features(spec, every, "fold", k)
        fixed = TR.cv_scores(best_est, every, k, parallelism=parallelism, folds=every_folds)
        rows = [(name, *fixed[name]) for name in best_est]
        if stacked_names:
            rows.append(("stacked", *EN.nested_stack_cv({n: best_est[n] for n in stacked_names}, every, k, stack.meta_C,
                                                        parallelism=parallelism, folds=every_folds)))
        cv = spark.createDataFrame(rows, "model string, cv_mean_auc double, cv_std_auc double")

    explanations = {}
    with timer.stage("explain"):
        for name, m in models.items():
            inner = m.stages[-1] if hasattr(m, "stages") else m
            if hasattr(inner, "featureImportances"):
                explanations[f"{name}_importances"] = X.importances(m, names, 15)
            if hasattr(inner, "coefficients") and inner.coefficients.size == len(names):
                explanations[f"{name}_coefficients"] = X.coefficients(m, names, 15)
                means = X.feature_means(train_x)
                per_row = X.linear_contributions(test_x, inner.coefficients.toArray(), means, names, "row_id")
            elif hasattr(inner, "featureImportances"):
                per_row = TS.tree_contributions(m, test_x, names)
            else:
                continue
            # Every test row explained; X5: their ranking
            explanations[f"{name}_attributions"] = per_row
            explanations[f"{name}_mean_abs"] = X.mean_abs_attribution(per_row)

    run_id = RL.new_run_id()

    def cv_rows(name: str, column: str) -> DataFrame:
        return cv.select(F.lit(run_id).alias("run_id"), "model", F.lit("cv").alias("kind"), F.lit(name).alias("name"),
                         F.col(column).alias("value"))

    long = RL.by_split(RL.metrics_long(metrics, run_id).unionByName(RL.report_long(report, run_id)))
    long = (long.unionByName(cv_rows("mean_roc_auc", "cv_mean_auc")).unionByName(cv_rows("std_roc_auc", "cv_std_auc"))
            .unionByName(RL.params_long(spark, chosen, run_id)))
    if out_dir:
        folder = out_dir.rstrip("/")
        with timer.stage("write"):
            # Preprocessing and each model, the meta model over the base scores beside them
            save_model(pre, split.drop("split"), f"{folder}/models/preprocessor")
            for name, m in models.items():
                save_model(m if isinstance(m, PipelineModel) else PipelineModel(stages=[m]), train_x,
                           f"{folder}/models/{name}")
            for name, m in metas.items():
                save_model(m if isinstance(m, PipelineModel) else PipelineModel(stages=[m]),
                           EN.stack_input(EN.base_scores({n: models[n] for n in stacked_names}, test_x), stacked_names),
                           f"{folder}/models/{name}")
            search_results.write.mode("append").parquet(f"{folder}/search")
            for name, df in explanations.items():
                df.write.mode("overwrite").parquet(f"{folder}/explanations/{name}")
    record = RL.run_record(spark, long, run_id, mode, timer, params)
    if out_dir:
        RL.append_records(record, long, out_dir)
    return RunResult(combined, profiles, search_results, metrics, report, cv, explanations, record, models)
