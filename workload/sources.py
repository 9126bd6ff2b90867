"""CSV, Parquet and JSON in and out, through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.operators.metrics import regression_metrics
from tabreg.operators.profile import category_dictionary
from tabreg.sources import (
    TRANSACTIONS_SCHEMA,
    ingest_csv,
    scan_parquet,
    shared_path,
    write_csv,
    write_json,
    write_partitioned,
)

from .fixture import AREA, CATEGORICAL, DATE, PARKING, TARGET, txn, with_ctes
from .registry import query, rounded

# Fixture columns under the names of the transactions schema.
_NAMES = {
    "transaction_id": "txn_id", "trans_group_en": "trans_group", "instance_date": DATE,
    "area_name_en": "area_name", "property_usage_en": "property_usage", "property_type_en": "property_type",
    "procedure_area": AREA, "has_parking": PARKING, "actual_worth": TARGET,
}


def _transactions_csv(spark: SparkSession, sf_dir: str) -> str:
    """``txn`` as a 46-column CSV in which some lines carry text in a number column."""
    rows = txn(spark, sf_dir)
    parking = F.when(F.col("txn_id") % 17 == 0, F.lit("n/a")).otherwise(F.col(PARKING).cast("string"))
    path = shared_path(spark, "transactions-csv")
    columns = [
        (parking if f.name == "has_parking" else F.col(_NAMES[f.name])).alias(f.name)
        if f.name in _NAMES
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in TRANSACTIONS_SCHEMA.fields
    ]
    write_csv(rows.select(*columns), path)
    return path


_CSV_SELECT = """SELECT CAST(txn_id AS VARCHAR) AS transaction_id, trans_group AS trans_group_en, instance_date,
  area_name AS area_name_en, property_usage AS property_usage_en, property_type AS property_type_en,
  procedure_area, has_parking, actual_worth FROM txn"""


@query(with_ctes("txn", select=_CSV_SELECT + " WHERE txn_id % 17 <> 0"))
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = ingest_csv(spark, _transactions_csv(spark, sf_dir), TRANSACTIONS_SCHEMA)
    return accepted.select(*_NAMES)


@query(with_ctes("txn", select="""SELECT CAST(txn_id % 17 = 0 AS BOOLEAN) AS rejected, count(*) AS line_count
  FROM txn GROUP BY 1"""))
def scan_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, rejected = ingest_csv(spark, _transactions_csv(spark, sf_dir), TRANSACTIONS_SCHEMA)
    flagged = accepted.select(F.lit(False).alias("rejected")).unionByName(
        rejected.select(F.lit(True).alias("rejected"))
    )
    return flagged.groupBy("rejected").agg(F.count(F.lit(1)).alias("line_count"))


@query(with_ctes("txn", select="""SELECT CAST(txn_id AS INT) AS txn_id, trans_group AS trans_group, instance_date, area_name,
  property_usage, property_type, procedure_area, has_parking, sparse_value, actual_worth FROM txn"""))
def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "inferred-csv")
    write_csv(txn(spark, sf_dir), path)
    accepted, _ = ingest_csv(spark, path)
    return accepted


@query(with_ctes("txn", select="""SELECT CAST(coalesce(year(try_strptime(instance_date, '%d-%m-%Y')), -1) AS INT) AS trans_year,
  count(*) AS row_count, round(sum(procedure_area), 2) AS area_sum FROM txn GROUP BY 1"""))
def stored_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "by-year")
    year = F.coalesce(F.year(F.try_to_date(F.col(DATE), "dd-MM-yyyy")), F.lit(-1))
    write_partitioned(txn(spark, sf_dir).withColumn("trans_year", year), path, ["trans_year"])
    stored = scan_parquet(spark, path).groupBy("trans_year")
    return rounded(
        stored.agg(F.count(F.lit(1)).alias("row_count"), F.sum(AREA).alias("area_sum")), 2, "area_sum"
    )


@query(with_ctes("txn", select=" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM txn WHERE {c} IS NOT NULL" for c in CATEGORICAL)))
def dictionary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "dictionary-json")
    write_json(category_dictionary(txn(spark, sf_dir), CATEGORICAL), path)
    return spark.read.schema("column_name string, value string").json(path)


@query(with_ctes("txn", select="""SELECT count(*) AS n_rows, round(sqrt(avg((actual_worth - 9000 * procedure_area) ** 2)), 2) AS rmse,
  round(avg(abs(actual_worth - 9000 * procedure_area)), 2) AS mae FROM txn
  WHERE actual_worth IS NOT NULL AND procedure_area IS NOT NULL"""))
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "metrics-json")
    scored = txn(spark, sf_dir).select(F.col(TARGET).alias("label"), (F.col(AREA) * 9000).alias("prediction"))
    write_json(regression_metrics(scored.na.drop()), path)
    stored = spark.read.schema("n_rows long, rmse double, mae double").json(path)
    return rounded(stored, 2, "rmse", "mae")
