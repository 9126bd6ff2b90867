"""Cleaning jobs: from raw transactions to rows fit for training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from ..operators.clean import (
    DEFAULT_KINDS,
    MissingValueImputer,
    OutlierFilter,
    SparseColumnDropper,
    deduplicate,
    deduplicate_rare,
    keep_kinds,
)
from ..operators.profile import RowAudit
from ..sources import stage

# Settings of the standard cleaning job.
PRICE_FACTOR = 3.0
SPARSE_THRESHOLD = 50.0


def sales_rows(
    df: DataFrame,
    kind_col: str,
    kinds: Sequence[str] = DEFAULT_KINDS,
    staged: bool = True,
    rare_duplicates: bool = False,
    audit: RowAudit | None = None,
) -> DataFrame:
    """Distinct rows of the wanted kinds: the one shuffle of a cleaning job.

    The filter runs before the shuffle. The steps that follow read this
    result several times, so it is stored in the shared folder unless
    ``staged`` is off. ``rare_duplicates`` shuffles fingerprints instead of
    rows, which pays when rows are wide, few repeat, and ``df`` is a stored table.
    An ``audit`` counts raw rows, wanted kinds and distinct rows while the result is stored.
    """
    if audit is not None and (not staged or rare_duplicates):
        raise ValueError("an audit needs a stored result and a single pass over the rows")
    wanted = keep_kinds(audit.step(df, "raw") if audit else df, kind_col, kinds)
    if audit:
        wanted = audit.step(wanted, "transaction kind")
    rows = deduplicate_rare(wanted) if rare_duplicates else deduplicate(wanted)
    if audit:
        rows = audit.step(rows, "deduplicate")
    return stage(rows, "sales") if staged else rows


def cleaning_pipeline(
    price_col: str,
    factor: float = PRICE_FACTOR,
    threshold: float = SPARSE_THRESHOLD,
    relative_error: float = 0.0,
    cache_input: bool = True,
    **imputation,
) -> Pipeline:
    """Price range, sparse columns, missing values, as one unfitted pipeline."""
    return Pipeline(
        stages=[
            OutlierFilter(
                inputCol=price_col,
                method="iqr",
                factor=factor,
                relativeError=relative_error,
                cacheInput=cache_input,
            ),
            SparseColumnDropper(threshold=threshold),
            MissingValueImputer(**imputation),
        ]
    )


def clean(
    df: DataFrame,
    price_col: str,
    kind_col: str,
    kinds: Sequence[str] = DEFAULT_KINDS,
    staged: bool = True,
    rare_duplicates: bool = False,
    **settings,
) -> tuple[DataFrame, PipelineModel]:
    """Standard job: dedup, kinds, price range x3, sparse columns, mean and 'Unknown' fills."""
    rows = sales_rows(df, kind_col, kinds, staged, rare_duplicates)
    model = cleaning_pipeline(price_col, cache_input=not staged, **settings).fit(rows)
    return model.transform(rows), model


def clean_for_serving(
    df: DataFrame,
    price_col: str,
    kind_col: str,
    kinds: Sequence[str] = DEFAULT_KINDS,
    factor: float = PRICE_FACTOR,
    staged: bool = True,
) -> DataFrame:
    """Variant for the served model: no column is dropped and nothing is filled."""
    rows = sales_rows(df, kind_col, kinds, staged)
    bounds = OutlierFilter(inputCol=price_col, method="iqr", factor=factor, cacheInput=not staged)
    return bounds.fit(rows).transform(rows)
