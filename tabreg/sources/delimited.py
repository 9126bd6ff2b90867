"""CSV input with an explicit account of malformed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .shared import stage

CORRUPT_COLUMN = "_corrupt_record"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    sampling_ratio: float = 1.0,
    **options,
) -> DataFrame:
    """Lazy scan of a CSV file with header.

    Lines that do not parse keep their text in ``_corrupt_record``. Without a
    schema the types are inferred first, from ``sampling_ratio`` of the lines.
    With one, header and schema must agree in order (a swapped column fails
    instead of being read under the wrong name).
    """
    reader = spark.read.option("header", True).options(**options)
    if schema is None:
        schema = reader.csv(path, inferSchema=True, samplingRatio=sampling_ratio).schema
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType())])
    return (
        reader.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("enforceSchema", False)
        .csv(path)
    )


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected lines) of a stored ``scan_csv`` result."""
    corrupt = F.col(CORRUPT_COLUMN)
    accepted = parsed.filter(corrupt.isNull()).drop(CORRUPT_COLUMN)
    rejected = parsed.filter(corrupt.isNotNull()).select(CORRUPT_COLUMN)
    return accepted, rejected


def ingest_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """Parse a CSV file once into a stored table and split it.

    What counts as malformed in a raw CSV scan depends on the columns a query
    happens to read; the stored table has parsed them all, so every later
    count agrees, and later passes read columns instead of text.
    """
    return split_corrupt(stage(scan_csv(spark, path, schema, **options), "csv"))
