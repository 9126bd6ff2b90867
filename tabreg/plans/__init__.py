"""Jobs composed from the operators."""

from .cleaning import clean, clean_for_serving, cleaning_pipeline, sales_rows
from .experiment import Comparison, compare_models, load_report, load_served, train_for_serving
from .folds import Preparation, PreparedFolds, prepare_folds
from .training import (
    CrossValidation,
    baseline_models,
    cross_validate,
    fit_models,
    serving_features,
    serving_fills,
    stack_predictions,
)

__all__ = [
    "Comparison",
    "CrossValidation",
    "Preparation",
    "PreparedFolds",
    "baseline_models",
    "clean",
    "clean_for_serving",
    "cleaning_pipeline",
    "compare_models",
    "cross_validate",
    "fit_models",
    "load_report",
    "load_served",
    "prepare_folds",
    "sales_rows",
    "serving_features",
    "serving_fills",
    "stack_predictions",
    "train_for_serving",
]
