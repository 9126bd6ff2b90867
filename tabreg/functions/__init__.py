"""Column-level building blocks: everything here maps columns to columns."""

from .binning import equal_width_bin
from .hashing import (
    hash_bucket,
    hash_digits,
    hash_fraction_below,
    poisson_count,
    poisson_cutoffs,
    poisson_positive,
)
from .money import amount_text, price_per_area
from .types import (
    categorical_columns,
    is_numeric,
    missing,
    numeric_columns,
    string_columns,
)

__all__ = [
    "amount_text",
    "categorical_columns",
    "equal_width_bin",
    "hash_bucket",
    "hash_digits",
    "hash_fraction_below",
    "is_numeric",
    "missing",
    "numeric_columns",
    "poisson_count",
    "poisson_cutoffs",
    "poisson_positive",
    "price_per_area",
    "string_columns",
]
