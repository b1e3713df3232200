"""tabflow: Spark-native tabular risk modelling.

The main entry points, re-exported for convenience; every function takes and returns
DataFrames (or Spark ML stages and models)."""

from tabflow.operators.clean import clean, coerce_numeric, dropped_counts
from tabflow.operators.harmonize import combine, harmonize, recode, rename
from tabflow.operators.profile import (category_counts, describe_approx, describe_exact, histogram,
                                       null_counts, profile, value_counts)
from tabflow.operators.split import sample_n, stratified_folds, stratified_split
from tabflow.plans.features import build_preprocessor, fit_preprocessor, slot_names
from tabflow.plans.metrics import class_report, confusion_matrix, evaluate, roc_auc
from tabflow.plans.train import PenalizedLogit, cv_score, make_estimator, search
from tabflow.plans.workflow import run
from tabflow.sources.io import load_model, read_raw, save_model, write_table
from tabflow.spec import FeatureSpec, GridSpec, SourceSpec, StackSpec

__all__ = ["clean", "coerce_numeric", "dropped_counts", "combine", "harmonize", "recode", "rename",
           "category_counts", "describe_approx", "describe_exact", "histogram", "null_counts",
           "profile", "value_counts", "sample_n", "stratified_folds", "stratified_split",
           "build_preprocessor", "fit_preprocessor", "slot_names", "class_report",
           "confusion_matrix", "evaluate", "roc_auc", "PenalizedLogit", "cv_score",
           "make_estimator", "search", "run", "load_model", "read_raw", "save_model", "write_table",
           "FeatureSpec", "GridSpec", "SourceSpec", "StackSpec"]
