"""Row filters, deduplication, and fitted cleaning steps.

Whatever is learned from data (price bounds, fill values, columns to drop) is
held by a fitted model, so that it can be learned on training rows only and
saved with the rest of a pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import is_numeric, missing, numeric_columns, string_columns
from ..sources import stage
from .quantiles import exact_quantiles, quantiles

# The kind of transaction kept by default, the text for a missing category.
DEFAULT_KINDS = ("Sales",)
UNKNOWN = "Unknown"


def of_kind(column: str, kinds: Sequence[str] = DEFAULT_KINDS) -> Column:
    """Condition: the column names one of ``kinds``, whatever its case or outer blanks."""
    return F.upper(F.trim(F.col(column))).isin([k.upper() for k in kinds])


def keep_kinds(df: DataFrame, column: str, kinds: Sequence[str] = DEFAULT_KINDS) -> DataFrame:
    return df.filter(of_kind(column, kinds))


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    prefer: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """One row per key, or per distinct whole row when no keys are given.

    With keys, the survivor is the first (or last) in the order of ``prefer``,
    ties broken by the remaining columns. It is a mergeable aggregate and not a
    ranking window, so a key that holds a third of all rows is collapsed inside
    each map task before anything is shuffled.
    """
    if not keys:
        return df.dropDuplicates()
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    ordered = list(prefer) + [c for c in df.columns if c not in prefer and c not in keys]
    pick = F.min if keep == "first" else F.max
    if not ordered:
        return df.select(*keys).distinct()
    survivor = df.groupBy(*keys).agg(pick(F.struct(*ordered)).alias("__row"))
    return survivor.select(*[F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns])


def deduplicate_rare(df: DataFrame) -> DataFrame:
    """Distinct whole rows of a wide table in which few rows are repeated.

    A first pass shuffles only a 64-bit fingerprint per row. Rows whose
    fingerprint occurs once are distinct and stay where they are; only the
    others go through the full shuffle. Equal rows have equal fingerprints, so
    the result is exact, whatever collides. The repeated fingerprints are a
    stored table, so the planner knows its size when it joins.
    """
    fingerprint = "__fingerprint"
    marked = df.withColumn(fingerprint, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    counted = marked.groupBy(fingerprint).agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counted.filter(F.col("n") > 1).select(fingerprint), "repeated")
    once = marked.join(repeated, fingerprint, "left_anti")
    several = marked.join(repeated, fingerprint, "left_semi")
    return once.drop(fingerprint).unionByName(several.drop(fingerprint).dropDuplicates())


def drop_missing_numeric(df: DataFrame) -> DataFrame:
    """Drop rows with NULL or NaN in any numeric column."""
    numbers = numeric_columns(df)
    return df.na.drop(subset=numbers) if numbers else df


def drop_missing_text(df: DataFrame) -> DataFrame:
    """Drop rows with NULL in any string column."""
    texts = string_columns(df)
    return df.na.drop(subset=texts) if texts else df


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where all of ``columns`` are present."""
    return df.na.drop(subset=list(columns))


class _OutlierParams(HasInputCol):
    action = Param(Params._dummy(), "action", "'filter' drops rows outside the bounds, 'clip' moves them to the bound", TypeConverters.toString)

    def _check_action(self) -> str:
        action = self.getOrDefault("action")
        if action not in ("filter", "clip"):
            raise ValueError(f"action must be 'filter' or 'clip', not {action!r}")
        return action


class OutlierFilter(Estimator, _OutlierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns an inclusive price range.

    ``iqr``: [max(0, q1 - factor * iqr), q3 + factor * iqr];
    ``percentile``: the ``lower`` and ``upper`` quantiles. Quantiles are exact
    unless ``relativeError`` is positive.
    """

    method = Param(Params._dummy(), "method", "'iqr' or 'percentile'", TypeConverters.toString)
    factor = Param(Params._dummy(), "factor", "multiple of the interquartile range", TypeConverters.toFloat)
    lower = Param(Params._dummy(), "lower", "lower quantile of method percentile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile of method percentile", TypeConverters.toFloat)
    relativeError = Param(Params._dummy(), "relativeError", "rank error of the quantiles, 0 for exact", TypeConverters.toFloat)
    cacheInput = Param(Params._dummy(), "cacheInput", "persist the column while fitting; off for a plain scan", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol=None, method="iqr", factor=1.5, lower=0.01, upper=0.99, relativeError=0.0, cacheInput=True, action="filter"):
        super().__init__()
        self._setDefault(method="iqr", factor=1.5, lower=0.01, upper=0.99, relativeError=0.0, cacheInput=True, action="filter")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "OutlierFilterModel":
        column, method = self.getInputCol(), self.getOrDefault("method")
        self._check_action()
        if method == "iqr":
            wanted = [0.25, 0.75]
        elif method == "percentile":
            wanted = [self.getOrDefault("lower"), self.getOrDefault("upper")]
        else:
            raise ValueError(f"method must be 'iqr' or 'percentile', not {method!r}")
        low, high = quantiles(
            dataset, column, wanted, self.getOrDefault("relativeError"), self.getOrDefault("cacheInput")
        )[column]
        if low is None:
            raise ValueError(f"column {column!r} has no values to learn bounds from")
        if method == "iqr":
            spread = self.getOrDefault("factor") * (high - low)
            low, high = max(0.0, low - spread), high + spread
        return self._copyValues(OutlierFilterModel(low, high))


class OutlierFilterModel(Model, _OutlierParams, DefaultParamsReadable, DefaultParamsWritable):
    lowerBound = Param(Params._dummy(), "lowerBound", "smallest accepted value", TypeConverters.toFloat)
    upperBound = Param(Params._dummy(), "upperBound", "largest accepted value", TypeConverters.toFloat)

    def __init__(self, lowerBound: float | None = None, upperBound: float | None = None):
        super().__init__()
        self._setDefault(action="filter")
        if lowerBound is not None:
            self._set(lowerBound=lowerBound, upperBound=upperBound)

    @property
    def bounds(self) -> tuple[float, float]:
        return self.getOrDefault("lowerBound"), self.getOrDefault("upperBound")

    def accepts(self) -> Column:
        """Condition: present and within the bounds (NaN is outside)."""
        value, (low, high) = F.col(self.getInputCol()), self.bounds
        return value.isNotNull() & value.between(F.lit(low), F.lit(high))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._check_action() == "filter":
            return dataset.filter(self.accepts())
        value, (low, high) = F.col(self.getInputCol()), self.bounds
        moved = F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))
        clipped = F.when(F.isnan(value.cast("double")), value).otherwise(moved)  # NaN is missing, not large
        return dataset.withColumn(self.getInputCol(), clipped)


class SparseColumnDropper(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Drops columns whose share of missing values is strictly above ``threshold`` percent."""

    threshold = Param(Params._dummy(), "threshold", "largest accepted percentage", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, threshold=50.0):
        super().__init__()
        self._setDefault(threshold=50.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SparseColumnDropperModel":
        fields = dataset.schema.fields
        row = dataset.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(missing(f)).alias(f"m{i}") for i, f in enumerate(fields)],
        ).first()
        limit, total = self.getOrDefault("threshold"), row["total"]
        return SparseColumnDropperModel(
            [f.name for i, f in enumerate(fields) if total and row[f"m{i}"] * 100.0 / total > limit]
        )


class SparseColumnDropperModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    dropped = Param(Params._dummy(), "dropped", "columns to drop", TypeConverters.toListString)

    def __init__(self, dropped: list[str] | None = None):
        super().__init__()
        self._set(dropped=dropped or [])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault("dropped"))


class _ImputerParams(HasInputCols):
    numericStrategy = Param(Params._dummy(), "numericStrategy", "mean, median, drop or keep", TypeConverters.toString)
    textStrategy = Param(Params._dummy(), "textStrategy", "unknown, mode, drop or keep", TypeConverters.toString)
    integerFill = Param(Params._dummy(), "integerFill", "'truncate' keeps integer columns integer, 'double' widens them", TypeConverters.toString)

    # Accepted settings.
    _CHOICES = {
        "numericStrategy": ("mean", "median", "drop", "keep"),
        "textStrategy": ("unknown", "mode", "drop", "keep"),
        "integerFill": ("truncate", "double"),
    }

    def _check(self) -> None:
        for name, accepted in self._CHOICES.items():
            if self.getOrDefault(name) not in accepted:
                raise ValueError(f"{name} must be one of {accepted}, not {self.getOrDefault(name)!r}")

    def _fields(self, dataset: DataFrame) -> list:
        wanted = self.getInputCols() if self.isSet("inputCols") else dataset.columns
        return [f for f in dataset.schema.fields if f.name in wanted]


class MissingValueImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills or drops missing values; fill values are learned in one pass.

    Means and medians are taken over the present, non-NaN values, and both
    NULL and NaN are filled. Only string columns get text fills. ``inputCols``
    defaults to all columns.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, numericStrategy="mean", textStrategy="unknown", integerFill="truncate"):
        super().__init__()
        self._setDefault(numericStrategy="mean", textStrategy="unknown", integerFill="truncate")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MissingValueImputerModel":
        self._check()
        fields = self._fields(dataset)
        numbers = [f.name for f in fields if is_numeric(f.dataType)]
        texts = string_columns(dataset.select([f"`{f.name}`" for f in fields]))
        fills: dict[str, object] = {}
        strategy = self.getOrDefault("numericStrategy")
        if strategy == "mean" and numbers:
            row = dataset.agg(*[present_mean(n).alias(f"v{i}") for i, n in enumerate(numbers)]).first()
            fills.update({n: row[f"v{i}"] for i, n in enumerate(numbers)})
        elif strategy == "median" and numbers:
            medians = exact_quantiles(dataset, numbers, [0.5], interpolate=True)
            fills.update({n: medians[n][0] for n in numbers})
        strategy = self.getOrDefault("textStrategy")
        if strategy == "unknown":
            fills.update(dict.fromkeys(texts, UNKNOWN))
        elif strategy == "mode" and texts:
            fills.update({r["column_name"]: r["value"] for r in most_frequent(dataset, texts).collect()})
        return self._copyValues(
            MissingValueImputerModel({k: v for k, v in fills.items() if v is not None})
        )


class MissingValueImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill value per column")

    def __init__(self, fills: dict | None = None):
        super().__init__()
        self._setDefault(numericStrategy="mean", textStrategy="unknown", integerFill="truncate")
        self._set(fills=fills or {})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.getOrDefault("fills")
        fields = self._fields(dataset)
        if self.getOrDefault("numericStrategy") == "drop":
            numbers = [f.name for f in fields if is_numeric(f.dataType)]
            dataset = dataset.na.drop(subset=numbers) if numbers else dataset
        if self.getOrDefault("textStrategy") == "drop":
            texts = string_columns(dataset.select([f"`{f.name}`" for f in fields]))
            dataset = dataset.na.drop(subset=texts) if texts else dataset
        filled = {
            f.name: self._filled(f, fills[f.name]).alias(f.name) for f in fields if f.name in fills
        }
        return dataset.select([filled.get(c, F.col(f"`{c}`")) for c in dataset.columns])

    def _filled(self, field, fill) -> Column:
        value = F.col(f"`{field.name}`")
        target = field.dataType
        if target.typeName() in ("integer", "long") and self.getOrDefault("integerFill") == "double":
            value, target = value.cast("double"), "double"
        return F.when(missing(field), F.lit(fill).cast(target)).otherwise(value)


def present_mean(name: str) -> Column:
    """Mean over the values that are neither NULL nor NaN."""
    value = F.col(f"`{name}`").cast("double")
    return F.avg(F.when(~F.isnan(value), value))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): the most frequent value, the smallest one on ties.

    Counted per (column, value) first, so the second step only sees one row
    per distinct value.
    """
    counted = (
        df.select([f"`{c}`" for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("column_name").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    )
