"""Type groups: which columns are treated as numbers, which as categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

# The four type names handled as numbers; all others are categories.
NUMERIC_TYPE_NAMES = ("double", "float", "integer", "long")
FLOATING_TYPE_NAMES = ("double", "float")


def is_numeric(data_type: DataType) -> bool:
    return data_type.typeName() in NUMERIC_TYPE_NAMES


def numeric_columns(source: DataFrame | StructType) -> list[str]:
    return [f.name for f in _fields(source) if is_numeric(f.dataType)]


def categorical_columns(source: DataFrame | StructType) -> list[str]:
    return [f.name for f in _fields(source) if not is_numeric(f.dataType)]


def string_columns(source: DataFrame | StructType) -> list[str]:
    return [f.name for f in _fields(source) if isinstance(f.dataType, StringType)]


def missing(field: StructField) -> Column:
    """NULL, or NaN where the type has one."""
    value = F.col(f"`{field.name}`")
    if field.dataType.typeName() in FLOATING_TYPE_NAMES:
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _fields(source: DataFrame | StructType) -> list[StructField]:
    schema = source.schema if isinstance(source, DataFrame) else source
    return schema.fields
