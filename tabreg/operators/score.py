"""Scoring of requests with a fitted pipeline, and request validation."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import amount_text, price_per_area
from .features import DATE_PATTERN

# Accepted input range of a request.
MIN_AREA, MAX_AREA = 1.0, 100_000.0
MIN_DATE, MAX_DATE = datetime.date(2004, 1, 1), datetime.date(2030, 12, 31)


def score(
    requests: DataFrame,
    model: Transformer | PipelineModel,
    area_col: str = "procedure_area",
    currency: str = "AED",
    prediction_col: str = "prediction",
) -> DataFrame:
    """Adds ``predicted_price`` (at least 0), ``price_per_area`` and ``price_text``.

    Stateless and narrow: the same call serves one row, a table or a stream. A request without a prediction has
    no price.
    """
    price = F.when(F.col(prediction_col).isNotNull(), F.greatest(F.lit(0.0), F.col(prediction_col)))
    return (
        model.transform(requests)
        .withColumn("predicted_price", price)
        .withColumn("price_per_area", price_per_area(F.col("predicted_price"), F.col(area_col)))
        .withColumn("price_text", amount_text(F.col("predicted_price"), currency))
    )


def validate_requests(
    requests: DataFrame,
    dictionary: DataFrame,
    categorical: Sequence[str],
    area_col: str = "procedure_area",
    date_col: str = "instance_date",
    min_date: datetime.date = MIN_DATE,
    max_date: datetime.date = MAX_DATE,
    pattern: str = DATE_PATTERN,
) -> DataFrame:
    """Adds ``area_ok``, ``date_ok``, ``<category>_ok`` and their conjunction ``is_valid``.

    A category is accepted when the dictionary (column_name, value) lists it. A stored dictionary lets the planner choose
    the join by its size.
    """
    day = F.col(date_col)
    if isinstance(requests.schema[date_col].dataType, StringType):
        day = F.try_to_date(day, pattern)
    flagged = requests.withColumns({
        "area_ok": _sure(F.col(area_col).between(MIN_AREA, MAX_AREA)),
        "date_ok": _sure(day.between(F.lit(min_date), F.lit(max_date))),
    })
    for name in categorical:
        known = (
            dictionary.filter(F.col("column_name") == name)
            .select(F.col("value").alias(name), F.lit(True).alias("__known"))
            .distinct()
        )
        flagged = flagged.join(known, name, "left")
        flagged = flagged.withColumn(f"{name}_ok", _sure(F.col("__known"))).drop("__known")
    flags = ["area_ok", "date_ok", *[f"{c}_ok" for c in categorical]]
    valid = flagged.withColumn("is_valid", F.least(*flags) if len(flags) > 1 else F.col(flags[0]))
    return valid.select(*requests.columns, *flags, "is_valid")


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
