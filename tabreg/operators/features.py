"""Calendar parts, category codes, feature vectors and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

# Output columns, date pattern, and suffix of encoded columns.
CALENDAR_COLUMNS = ("trans_year", "trans_month", "trans_quarter", "trans_dayofweek")
DATE_PATTERN = "dd-MM-yyyy"
CODE_SUFFIX = "_indexed"


class CalendarFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds year, month, quarter and day of week (Sunday = 1) of a date column.

    Text is parsed with ``pattern``; what does not parse becomes NULL. With
    ``weekendDays`` (day-of-week numbers) a boolean ``is_weekend`` is added.
    The same stage runs in training and in scoring.
    """

    dateCol = Param(Params._dummy(), "dateCol", "date, timestamp or text column", TypeConverters.toString)
    pattern = Param(Params._dummy(), "pattern", "pattern of text dates", TypeConverters.toString)
    weekendDays = Param(Params._dummy(), "weekendDays", "day-of-week numbers that are weekend", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, dateCol=None, pattern=DATE_PATTERN, weekendDays=()):
        super().__init__()
        self._setDefault(pattern=DATE_PATTERN, weekendDays=[])
        self._set(**{**self._input_kwargs, "weekendDays": list(weekendDays)})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault("dateCol")
        day = F.col(name)
        if isinstance(dataset.schema[name].dataType, StringType):
            day = F.try_to_date(day, self.getOrDefault("pattern"))
        parts = [F.year(day), F.month(day), F.quarter(day), F.dayofweek(day)]
        added = dict(zip(CALENDAR_COLUMNS, parts))
        if weekend := self.getOrDefault("weekendDays"):
            added["is_weekend"] = F.dayofweek(day).isin(weekend)
        return dataset.withColumns(added)


class LabelColumn(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``label``: the target as double."""

    targetCol = Param(Params._dummy(), "targetCol", "target column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, targetCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("label", F.col(self.getOrDefault("targetCol")).cast("double"))


class RequiredInputs(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Blanks the prediction where an input of the vector is missing, and names the first such input.

    Follows a model whose vector keeps incomplete rows: every row comes back, with a NULL prediction and its name in
    ``unscored_reason``, or with a prediction and NULL there.
    """

    inputCols = Param(Params._dummy(), "inputCols", "numeric inputs that must be present", TypeConverters.toListString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column to blank", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=(), predictionCol="prediction"):
        super().__init__()
        self._setDefault(inputCols=[], predictionCol="prediction")
        self._set(**{**self._input_kwargs, "inputCols": list(inputCols)})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, prediction = self.getOrDefault("inputCols"), self.getOrDefault("predictionCol")
        absent = [
            F.when(F.col(n).isNull() | F.isnan(F.col(n).cast("double")), F.lit(n)) for n in names
        ]
        reason = F.coalesce(*absent, F.lit(None).cast("string"))
        return dataset.withColumn("unscored_reason", reason).withColumn(
            prediction, F.when(F.col("unscored_reason").isNull(), F.col(prediction))
        )


def coded(columns: Sequence[str]) -> list[str]:
    return [c + CODE_SUFFIX for c in columns]


def category_indexer(columns: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """One indexer for all columns, so all dictionaries come from a single pass.

    Codes follow frequency, then the value. ``keep`` sends missing and unseen
    values to one extra code, ``skip`` drops the row, ``error`` raises.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=coded(columns), handleInvalid=handle_invalid
    )


def one_hot_encoder(columns: Sequence[str], drop_last: bool = False) -> OneHotEncoder:
    """Indicator vectors for coded columns, an alternative to using codes as numbers."""
    return OneHotEncoder(
        inputCols=coded(columns),
        outputCols=[c + "_onehot" for c in columns],
        dropLast=drop_last,
    )


def feature_assembler(
    numeric: Sequence[str], encoded: Sequence[str], output: str = "features"
) -> VectorAssembler:
    """Numeric columns first, then encoded ones; rows with a missing input are dropped.

    The vector keeps each code's nominal attribute, which is what makes trees
    split codes as categories.
    """
    return VectorAssembler(
        inputCols=[*numeric, *encoded], outputCol=output, handleInvalid="skip"
    )


def scaler(method: str = "standard", input_col: str = "features", output_col: str = "scaled_features", center: bool = True):
    """``standard``: (centred) unit sample deviation; ``minmax``: [0, 1]."""
    if method == "standard":
        return StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=center)
    if method == "minmax":
        return MinMaxScaler(inputCol=input_col, outputCol=output_col)
    raise ValueError(f"unknown scaling method: {method!r}")


def feature_pipeline(
    numeric: Sequence[str],
    categorical: Sequence[str],
    date_col: str | None = None,
    target_col: str | None = None,
    one_hot: bool = False,
    scaling: str | None = None,
) -> Pipeline:
    """Unfitted pipeline: [calendar,] codes, [indicators,] vector[, scaled vector][, label].

    Scaling inside a pipeline does not centre, which keeps sparse vectors sparse.
    """
    stages: list = []
    numbers = list(numeric)
    if date_col:
        stages.append(CalendarFeatures(dateCol=date_col))
        numbers += CALENDAR_COLUMNS
    stages.append(category_indexer(categorical))
    encoded = coded(categorical)
    if one_hot:
        stages.append(one_hot_encoder(categorical))
        encoded = [c + "_onehot" for c in categorical]
    stages.append(feature_assembler(numbers, encoded))
    if scaling:
        stages.append(scaler(scaling, center=False))
    if target_col:
        stages.append(LabelColumn(targetCol=target_col))
    return Pipeline(stages=stages)


def engineer_features(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    date_col: str,
    target_col: str,
    **options,
) -> tuple[DataFrame, list[str], PipelineModel]:
    """Fit the feature pipeline on ``df`` and apply it: (rows, feature names, model)."""
    model = feature_pipeline(numeric, categorical, date_col, target_col, **options).fit(df)
    return model.transform(df), [*numeric, *CALENDAR_COLUMNS, *coded(categorical)], model


def vector_attributes(df: DataFrame, column: str = "features") -> list[dict]:
    """The ML attributes of a vector column, by slot; [] when it carries none."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    return sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])


def vector_width(df: DataFrame, column: str = "features") -> int:
    """Number of slots that the metadata of a vector column states, 0 when it states none."""
    return df.schema[column].metadata.get("ml_attr", {}).get("num_attrs", 0) or len(vector_attributes(df, column))


def largest_arity(df: DataFrame, column: str = "features") -> int:
    """Number of categories of the widest nominal slot, 0 when there is none."""
    return max(
        (
            a["num_vals"] if "num_vals" in a else len(a.get("vals", []))
            for a in vector_attributes(df, column)
            if "num_vals" in a or "vals" in a
        ),
        default=0,
    )
