"""Cleaning: filters, dedup, price range, sparse columns, imputation, whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.operators.arrivals import DistinctStore
from tabreg.operators.clean import (
    MissingValueImputer,
    OutlierFilter,
    SparseColumnDropper,
    deduplicate,
    deduplicate_rare,
    drop_missing_numeric,
    drop_missing_text,
    fill_constants,
    keep_kinds,
    require,
)
from tabreg.operators.features import CalendarFeatures
from tabreg.plans import clean, clean_for_serving
from tabreg.sources import stage

from .fixture import AREA, CATEGORICAL, COLUMNS, DATE, KIND, PARKING, TARGET, txn, txn_nan, with_ctes
from .registry import query, rounded


@query(with_ctes("txn", select="SELECT * FROM txn WHERE upper(trim(trans_group)) IN ('SALES')"))
def filter_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_kinds(txn(spark, sf_dir), KIND)


@query(with_ctes("txn", select="SELECT * FROM txn WHERE upper(trim(trans_group)) IN ('SALES', 'MORTGAGES')"))
def filter_type_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_kinds(txn(spark, sf_dir), KIND, ["sales", "Mortgages"])


@query(with_ctes("txn", select="SELECT DISTINCT * FROM txn"))
def dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(txn(spark, sf_dir))


@query(with_ctes("txn", select="SELECT DISTINCT * FROM txn"))
def dedup_all_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_rare(stage(txn(spark, sf_dir), "txn"))


@query(with_ctes("txn", select="SELECT DISTINCT * FROM txn WHERE txn_id % 3 = 0"))
def dedup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of all rows against a store that has two thirds of them; only the delivery is shuffled."""
    rows = stage(txn(spark, sf_dir), "txn")
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    store = DistinctStore.create(rows.filter("txn_id % 3 <> 0"), f"distinct_{uuid.uuid4().hex}", buckets)
    return store.new_rows(rows)


@query(with_ctes("txn", select="""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY area_name, property_usage ORDER BY instance_date NULLS FIRST, txn_id) AS rn FROM txn) WHERE rn = 1"""))
def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(txn(spark, sf_dir), ["area_name", "property_usage"], prefer=[DATE, "txn_id"])


def _outlier_sql(low: str, high: str, select: str) -> str:
    return with_ctes("txn", extra=f"""qs AS (SELECT quantile_disc(actual_worth, 0.25) AS q1, quantile_disc(actual_worth, 0.75) AS q3,
  quantile_disc(actual_worth, 0.01) AS p01, quantile_disc(actual_worth, 0.99) AS p99 FROM txn),
lim AS (SELECT {low} AS lo, {high} AS hi FROM qs)""", select=select)


_WITHIN = "SELECT txn.* FROM txn, lim WHERE actual_worth BETWEEN lo AND hi"


@query(_outlier_sql("greatest(CAST(0 AS DOUBLE), q1 - 1.5 * (q3 - q1))", "q3 + 1.5 * (q3 - q1)", _WITHIN))
def outlier_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return OutlierFilter(inputCol=TARGET).fit(rows).transform(rows)


@query(_outlier_sql("p01", "p99", _WITHIN))
def outlier_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return OutlierFilter(inputCol=TARGET, method="percentile").fit(rows).transform(rows)


@query(_outlier_sql("p01", "p99", """SELECT txn.* REPLACE (CASE WHEN actual_worth IS NOT NULL
  THEN greatest(least(actual_worth, hi), lo) END AS actual_worth) FROM txn, lim"""))
def outlier_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return OutlierFilter(inputCol=TARGET, method="percentile", action="clip").fit(rows).transform(rows)


@query(with_ctes("txn", extra="""n AS (SELECT txn_id, CASE WHEN txn_id % 23 <> 0 THEN procedure_area END AS area FROM txn),
lim AS (SELECT quantile_disc(area, 0.01) AS lo, quantile_disc(area, 0.99) AS hi FROM n)""",
    select="SELECT txn_id, txn_id % 23 = 0 AS was_nan, CASE WHEN area IS NOT NULL THEN greatest(least(area, hi), lo) END AS area FROM n, lim"))
def outlier_clip_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN stays NaN (shown as NULL with a flag) and is not moved to a bound."""
    rows = txn_nan(spark, sf_dir).select("txn_id", "nan_area")
    clipped = OutlierFilter(inputCol="nan_area", method="percentile", action="clip").fit(rows).transform(rows)
    return clipped.select(
        "txn_id", F.coalesce(F.isnan("nan_area"), F.lit(False)).alias("was_nan"),
        F.when(~F.isnan("nan_area"), F.col("nan_area")).alias("area"),
    )


@query(with_ctes("txn", select="SELECT * EXCLUDE (sparse_value) FROM txn"))
def drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return SparseColumnDropper(threshold=50.0).fit(rows).transform(rows)


_PRESENT_NAN = "avg(nan_area) FILTER (WHERE NOT isnan(nan_area))"


@query(with_ctes("txn_nan", extra=f"""m AS (SELECT avg(procedure_area) AS m_area, CAST(trunc(avg(has_parking)) AS INT) AS m_parking,
  avg(sparse_value) AS m_sparse, avg(actual_worth) AS m_worth, {_PRESENT_NAN} AS m_nan FROM txn_nan)""",
    select="""SELECT txn_id, trans_group, instance_date, area_name, property_usage, property_type,
  round(coalesce(procedure_area, m_area), 4) AS procedure_area, coalesce(has_parking, m_parking) AS has_parking,
  round(coalesce(sparse_value, m_sparse), 4) AS sparse_value, round(coalesce(actual_worth, m_worth), 4) AS actual_worth,
  round(CASE WHEN nan_area IS NULL OR isnan(nan_area) THEN m_nan ELSE nan_area END, 4) AS nan_area FROM txn_nan, m"""))
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn_nan(spark, sf_dir)
    filled = MissingValueImputer(numericStrategy="mean", textStrategy="keep").fit(rows).transform(rows)
    return rounded(filled, 4, AREA, "sparse_value", TARGET, "nan_area")


@query(with_ctes("txn", extra="m AS (SELECT avg(has_parking) AS m_parking FROM txn)",
    select="SELECT txn_id, round(coalesce(CAST(has_parking AS DOUBLE), m_parking), 6) AS has_parking FROM txn, m"))
def impute_mean_as_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir).select("txn_id", PARKING)
    model = MissingValueImputer(inputCols=[PARKING], integerFill="double", textStrategy="keep").fit(rows)
    return rounded(model.transform(rows), 6, PARKING)


@query(with_ctes("txn", extra="""m AS (SELECT median(procedure_area) AS m_area, CAST(trunc(median(has_parking)) AS INT) AS m_parking,
  median(sparse_value) AS m_sparse, median(actual_worth) AS m_worth FROM txn)""",
    select="""SELECT txn_id, coalesce(procedure_area, m_area) AS procedure_area, coalesce(has_parking, m_parking) AS has_parking,
  round(coalesce(sparse_value, m_sparse), 6) AS sparse_value, round(coalesce(actual_worth, m_worth), 6) AS actual_worth FROM txn, m"""))
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir).select("txn_id", AREA, PARKING, "sparse_value", TARGET)
    model = MissingValueImputer(numericStrategy="median", textStrategy="keep").fit(rows)
    return rounded(model.transform(rows), 6, "sparse_value", TARGET)


@query(with_ctes("txn", select="""SELECT * FROM txn WHERE procedure_area IS NOT NULL AND has_parking IS NOT NULL
  AND sparse_value IS NOT NULL AND actual_worth IS NOT NULL"""), name="drop_missing_numeric")
def drop_missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing_numeric(txn(spark, sf_dir))


@query(with_ctes("txn_nan", select="""SELECT txn_id, nan_area FROM txn_nan
  WHERE nan_area IS NOT NULL AND NOT isnan(nan_area)"""))
def drop_missing_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing_numeric(txn_nan(spark, sf_dir).select("txn_id", "nan_area"))


@query(with_ctes("txn", select="""SELECT * REPLACE (coalesce(instance_date, 'Unknown') AS instance_date,
  coalesce(area_name, 'Unknown') AS area_name) FROM txn"""))
def impute_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return MissingValueImputer(numericStrategy="keep", textStrategy="unknown").fit(rows).transform(rows)


@query(with_ctes("txn", select="SELECT * FROM txn WHERE instance_date IS NOT NULL AND area_name IS NOT NULL"), name="drop_missing_categorical")
def drop_missing_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing_text(txn(spark, sf_dir))


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM txn WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(with_ctes("txn", select=f"""SELECT txn_id, coalesce(instance_date, {_mode_sql('instance_date')}) AS instance_date,
  coalesce(area_name, {_mode_sql('area_name')}) AS area_name, property_usage FROM txn"""))
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir).select("txn_id", DATE, "area_name", "property_usage")
    return MissingValueImputer(numericStrategy="keep", textStrategy="mode").fit(rows).transform(rows)


@query(with_ctes("txn", select="""SELECT * REPLACE (coalesce(has_parking, 0) AS has_parking,
  coalesce(area_name, 'Unknown') AS area_name, coalesce(procedure_area, 10.0) AS procedure_area) FROM txn"""))
def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_constants(txn(spark, sf_dir), {PARKING: 0, "area_name": "Unknown", AREA: 10.0})


@query(with_ctes("txn", select="""SELECT * FROM (SELECT *, CAST(year(try_strptime(instance_date, '%d-%m-%Y')) AS INT) AS trans_year FROM txn)
  WHERE actual_worth IS NOT NULL AND trans_year IS NOT NULL"""))
def filter_valid_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = CalendarFeatures(dateCol=DATE).transform(txn(spark, sf_dir))
    return require(dated, [TARGET, "trans_year"]).select(*COLUMNS, "trans_year")


@query(with_ctes("clean", select="SELECT * REPLACE (round(procedure_area, 6) AS procedure_area) FROM clean"))
def clean_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = clean(txn(spark, sf_dir), TARGET, KIND)
    return rounded(rows, 6, AREA)


@query(with_ctes("kept", select="SELECT * FROM kept"))
def clean_pipeline_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_for_serving(txn(spark, sf_dir), TARGET, KIND)
