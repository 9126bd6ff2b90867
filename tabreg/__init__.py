"""Tabular regression on Spark: profile, clean, encode, split, train, compare, score."""

from .operators.clean import MissingValueImputer, OutlierFilter, SparseColumnDropper, deduplicate, keep_kinds
from .operators.arrivals import DistinctStore, FileProfile
from .operators.codes import code_dictionary, encode_stored
from .operators.ensemble import BaggingRegressionModel, BaggingRegressor
from .operators.features import CalendarFeatures, engineer_features, feature_pipeline
from .operators.metrics import cv_summary, evaluate, model_comparison, regression_metrics
from .operators.profile import RowAudit, describe, missing_report, schema_rows
from .operators.quantiles import approx_quantiles, exact_quantiles
from .operators.ranks import row_numbers
from .operators.resample import (
    assign_folds,
    assign_stratified_folds,
    bootstrap_exact,
    bootstrap_rows,
    bootstrap_weight,
    fold_split,
    holdout_split,
)
from .operators.score import score, validate_requests
from .plans import (
    Preparation,
    clean,
    clean_for_serving,
    compare_models,
    cross_validate,
    fit_models,
    load_report,
    load_served,
    prepare_folds,
    train_for_serving,
)
from .sources import ingest_csv, newest_version, publish, scan_csv, scan_parquet, stage

__version__ = "0.1.0"

__all__ = [
    "BaggingRegressionModel",
    "BaggingRegressor",
    "CalendarFeatures",
    "DistinctStore",
    "FileProfile",
    "MissingValueImputer",
    "OutlierFilter",
    "Preparation",
    "RowAudit",
    "SparseColumnDropper",
    "approx_quantiles",
    "assign_folds",
    "assign_stratified_folds",
    "bootstrap_exact",
    "bootstrap_rows",
    "bootstrap_weight",
    "clean",
    "clean_for_serving",
    "code_dictionary",
    "compare_models",
    "cross_validate",
    "cv_summary",
    "deduplicate",
    "describe",
    "encode_stored",
    "engineer_features",
    "evaluate",
    "exact_quantiles",
    "feature_pipeline",
    "fit_models",
    "fold_split",
    "holdout_split",
    "ingest_csv",
    "keep_kinds",
    "load_report",
    "load_served",
    "missing_report",
    "model_comparison",
    "newest_version",
    "prepare_folds",
    "publish",
    "regression_metrics",
    "row_numbers",
    "scan_csv",
    "scan_parquet",
    "schema_rows",
    "score",
    "stage",
    "train_for_serving",
    "validate_requests",
]
