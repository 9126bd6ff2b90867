"""Profiles of a table as tables; every profile is one pass over the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions import is_numeric, missing


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: for each column the number of missing values."""
    return df.agg(*[F.count_if(missing(f)).alias(f.name) for f in df.schema.fields])


def missing_report(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """One row per column: ``missing_count``, ``missing_pct`` (2 decimals), ``dtype``."""
    fields = df.schema.fields
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(missing(f)).alias(f"m{i}") for i, f in enumerate(fields)],
    )
    report = _one_row_per_column(
        wide,
        [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"m{i}").alias("missing_count"),
                F.round(F.try_divide(F.col(f"m{i}") * 100.0, F.col("total")), 2).alias("missing_pct"),
                F.lit(f.dataType.typeName()).alias("dtype"),
            )
            for i, f in enumerate(fields)
        ],
    )
    return report.filter(F.col("missing_count") > 0) if only_missing else report


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, stddev, min and max of the numeric and string columns, long form.

    Numbers have ``min_value``/``max_value``, strings ``min_text``/``max_text``.
    """
    fields = [
        f
        for f in df.schema.fields
        if (is_numeric(f.dataType) or isinstance(f.dataType, StringType))
        and (columns is None or f.name in columns)
    ]
    aggregates, rows = [], []
    for i, f in enumerate(fields):
        value, numeric = F.col(f"`{f.name}`"), is_numeric(f.dataType)
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
        ]
        if numeric:
            aggregates += [F.avg(value).alias(f"avg{i}"), F.stddev(value).alias(f"sd{i}")]
        no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"n{i}").alias("value_count"),
                (F.col(f"avg{i}") if numeric else no_number).alias("mean"),
                (F.col(f"sd{i}") if numeric else no_number).alias("stddev"),
                (F.col(f"lo{i}").cast("double") if numeric else no_number).alias("min_value"),
                (F.col(f"hi{i}").cast("double") if numeric else no_number).alias("max_value"),
                (no_text if numeric else F.col(f"lo{i}")).alias("min_text"),
                (no_text if numeric else F.col(f"hi{i}")).alias("max_text"),
            )
        )
    return _one_row_per_column(df.agg(*aggregates), rows)


def table_counts(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows: position, column_name, dtype, nullable."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, dtype string, nullable boolean")


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The n first rows in a stated order (a top-k, not a global sort)."""
    return df.orderBy(*order_by).limit(n)


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, as (column_name, value).

    One scan for all columns; duplicates collapse on the map side, so the
    shuffle carries at most the dictionary itself per task.
    """
    text = df.select([F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def retention_audit(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows before and after whole-row dedup and each further filter, in order.

    All steps come out of one shuffle: rows are grouped by all columns with
    their multiplicity, then every step is a conditional count. A NULL
    condition drops the row, as in a filter.
    """
    multiplicity = "__copies"
    distinct_rows = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(
        F.count(F.lit(1)).alias(multiplicity)
    )
    counts = [
        F.coalesce(F.sum(multiplicity), F.lit(0)).alias("raw"),
        F.count(F.lit(1)).alias("s0"),
    ]
    passed = F.lit(True)
    for i, condition in enumerate(conditions.values(), start=1):
        passed = passed & condition
        counts.append(F.count_if(passed).alias(f"s{i}"))
    steps = ["deduplicate", *conditions]
    before = ["raw", *[f"s{i}" for i in range(len(conditions))]]
    rows = [
        F.struct(
            F.lit(i + 1).alias("step_no"),
            F.lit(step).alias("step"),
            F.col(before[i]).alias("rows_in"),
            F.col(f"s{i}").alias("rows_out"),
            F.round(F.try_divide(F.col(f"s{i}") * 100.0, F.col(before[i])), 2).alias("kept_pct"),
            F.round(F.try_divide(F.col(f"s{i}") * 100.0, F.col("raw")), 2).alias("kept_of_raw_pct"),
        )
        for i, step in enumerate(steps)
    ]
    return _one_row_per_column(distinct_rows.agg(*counts), rows)


class RowAudit:
    """Counts rows at named steps of a job while the job itself writes them: no job, scan or shuffle of its own.

    ``step`` returns the frame to go on with; what it counts is there once a frame built on it was written. Each step must be run once. Where
    an executor is lost, Spark may run tasks of a step again and then counts their rows twice: the table is a report, not a check.
    """

    def __init__(self):
        self._steps: list[tuple[str, Observation]] = []

    def step(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation(name)
        self._steps.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(step_no, step, rows_in, rows_out, kept_pct, kept_of_raw_pct); the first step gives the raw rows."""
        counts = [(name, seen.get["n"]) for name, seen in self._steps]
        rows = [(i, name, before, after, counts[0][1]) for i, ((_, before), (name, after)) in enumerate(zip(counts, counts[1:]), 1)]
        out = spark.createDataFrame(rows, "step_no int, step string, rows_in long, rows_out long, raw long")

        def share(of: str) -> Column:
            return F.round(F.try_divide(F.col("rows_out") * 100.0, F.col(of)), 2)

        return out.select(
            "step_no", "step", "rows_in", "rows_out", share("rows_in").alias("kept_pct"), share("raw").alias("kept_of_raw_pct")
        )


def _one_row_per_column(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn the single row of a wide aggregate into one row per struct."""
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
