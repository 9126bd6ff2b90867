"""Schema of the property transactions file and the role of its columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Field names, order and types of the transactions CSV (46 fields).
_TRANSACTION_FIELDS = """
    transaction_id STRING, procedure_id STRING,
    trans_group_id STRING, trans_group_ar STRING, trans_group_en STRING,
    procedure_name_ar STRING, procedure_name_en STRING, instance_date STRING,
    property_type_id STRING, property_type_ar STRING, property_type_en STRING,
    property_sub_type_id STRING, property_sub_type_ar STRING, property_sub_type_en STRING,
    property_usage_ar STRING, property_usage_en STRING,
    reg_type_id STRING, reg_type_ar STRING, reg_type_en STRING,
    area_id STRING, area_name_ar STRING, area_name_en STRING,
    building_name_ar STRING, building_name_en STRING,
    project_number STRING, project_name_ar STRING, project_name_en STRING,
    master_project_en STRING, master_project_ar STRING,
    nearest_landmark_ar STRING, nearest_landmark_en STRING,
    nearest_metro_ar STRING, nearest_metro_en STRING,
    nearest_mall_ar STRING, nearest_mall_en STRING,
    rooms_ar STRING, rooms_en STRING,
    has_parking INT, procedure_area DOUBLE, actual_worth DOUBLE,
    meter_sale_price DOUBLE, rent_value DOUBLE, meter_rent_price DOUBLE,
    no_of_parties_role_1 INT, no_of_parties_role_2 INT, no_of_parties_role_3 INT
"""

_TYPES = {"STRING": StringType(), "INT": IntegerType(), "DOUBLE": DoubleType()}

TRANSACTIONS_SCHEMA = StructType(
    [StructField(name, _TYPES[kind]) for name, kind in map(str.split, _TRANSACTION_FIELDS.split(","))]
)


@dataclass(frozen=True)
class ColumnRoles:
    """Which column plays which part in a training or scoring job."""

    target: str
    kind: str
    date: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    date_format: str = "dd-MM-yyyy"


# Roles of the columns above.
TRANSACTION_ROLES = ColumnRoles(
    target="actual_worth",
    kind="trans_group_en",
    date="instance_date",
    numeric=("procedure_area", "has_parking"),
    categorical=(
        "property_type_en",
        "property_usage_en",
        "area_name_en",
        "nearest_metro_en",
        "nearest_mall_en",
    ),
)
