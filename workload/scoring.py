"""Scoring of requests in batch and as a stream, and request validation."""

from __future__ import annotations

import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.operators.clean import MissingValueImputer
from tabreg.operators.ensemble import BaggingRegressor
from tabreg.operators.features import CalendarFeatures, LabelColumn, category_indexer, coded, feature_assembler
from tabreg.operators.profile import category_dictionary
from tabreg.operators.score import score, validate_requests
from tabreg.plans import clean_for_serving, load_report, load_served, sales_rows, train_for_serving
from tabreg.sources import ColumnRoles, shared_path, stage
from tabreg.streaming import read_requests, write_scores

from .features import clean_rows
from .fixture import AREA, CATEGORICAL, DATE, KIND, PARKING, TARGET, txn, with_ctes
from .models import (
    BAGGING, CELL, TREES, _METRICS, _ROUNDED_METRICS, _holdout, _money_sql, _shown_metrics, cell_bagging,
)
from .registry import query, rounded
from .resampling import SEED, in_train_sql, poisson_sql


def served_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """Fills, calendar parts, codes, vector and ensemble, fitted on all clean rows."""
    rows = LabelColumn(targetCol=TARGET).transform(stage(clean_rows(spark, sf_dir)))
    return Pipeline(stages=[
        MissingValueImputer(inputCols=CATEGORICAL, textStrategy="unknown"),
        CalendarFeatures(dateCol=DATE),
        category_indexer(CELL),
        feature_assembler([], coded(CELL)),
        cell_bagging(),
    ]).fit(rows)


_SCORED = f"""drawn AS (SELECT c.*, i, {poisson_sql(f"concat('{SEED}:', i)")} AS w FROM clean c, range({TREES}) AS draws(i)),
cells AS (SELECT area_name, property_type, avg(mean_i) AS prediction FROM (SELECT area_name, property_type, i,
  sum(w * actual_worth) / sum(w) AS mean_i FROM drawn GROUP BY ALL) GROUP BY ALL),
scored AS (SELECT txn_id, greatest(CAST(0 AS DOUBLE), prediction) AS price, procedure_area
  FROM txn JOIN cells ON coalesce(txn.area_name, 'Unknown') = cells.area_name AND txn.property_type = cells.property_type)"""
_SCORES = f"""SELECT txn_id, round(price, 2) AS predicted_price,
  round(CASE WHEN procedure_area > 0 THEN price / procedure_area ELSE 0 END, 4) AS price_per_area,
  concat('AED ', {_money_sql('price')}) AS price_text FROM scored"""
_COLUMNS = ["txn_id", "predicted_price", "price_per_area", "price_text"]


@query(with_ctes("clean", extra=_SCORED, select=_SCORES))
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(txn(spark, sf_dir), served_model(spark, sf_dir), AREA).select(*_COLUMNS)
    return rounded(rounded(scored, 2, "predicted_price"), 4, "price_per_area")


@query(with_ctes("clean", extra=_SCORED, select=_SCORES))
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests as stored files read by a stream, scored into a Parquet sink."""
    requests = shared_path(spark, "requests")
    txn(spark, sf_dir).write.parquet(requests)
    schema = spark.read.parquet(requests).schema
    sink = shared_path(spark, "scores")
    running = write_scores(
        read_requests(spark, requests, schema),
        served_model(spark, sf_dir),
        _COLUMNS,
        sink,
        shared_path(spark, "scores-checkpoint"),
        available_now=True,
        area_col=AREA,
    )
    running.awaitTermination()
    return rounded(rounded(spark.read.parquet(sink), 2, "predicted_price"), 4, "price_per_area")


_FROM, _TO = datetime.date(1996, 1, 1), datetime.date(2000, 12, 31)


@query(with_ctes("sales", extra=f"""asked AS (SELECT *, CAST(try_strptime(instance_date, '%d-%m-%Y') AS DATE) AS d FROM txn),
flags AS (SELECT txn_id, coalesce(procedure_area BETWEEN 1 AND 100000, false) AS area_ok,
  coalesce(d BETWEEN DATE '{_FROM}' AND DATE '{_TO}', false) AS date_ok,
  """ + ", ".join(f"coalesce({c} IN (SELECT {c} FROM sales WHERE {c} IS NOT NULL), false) AS {c}_ok" for c in CATEGORICAL) + """ FROM asked)""",
    select="""SELECT *, area_ok AND date_ok AND area_name_ok AND property_usage_ok AND property_type_ok AS is_valid FROM flags"""))
def score_input_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    known = stage(category_dictionary(sales_rows(rows, KIND, staged=False), CATEGORICAL), "dictionary")
    checked = validate_requests(rows, known, CATEGORICAL, AREA, DATE, min_date=_FROM, max_date=_TO)
    return checked.drop(*[c for c in rows.columns if c != "txn_id"])


_CELL_ROLES = ColumnRoles(target=TARGET, kind=KIND, date=DATE, numeric=(), categorical=tuple(CELL))
_SERVED = f"""rows_ AS (SELECT txn_id, coalesce(area_name, 'Unknown') AS area_name, property_type, actual_worth AS label,
  {in_train_sql()} AS in_train FROM kept WHERE try_strptime(instance_date, '%d-%m-%Y') IS NOT NULL),
drawn AS (SELECT r.*, i, {poisson_sql(f"concat('{SEED}:', i)")} AS w FROM rows_ r, range({TREES}) AS draws(i))"""


@query(with_ctes("kept", extra=_SERVED, select=f"SELECT {_ROUNDED_METRICS} FROM (SELECT {_METRICS} FROM ({_holdout(BAGGING)}))"))
def serving_job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served model trained and stored; its holdout metrics read back."""
    path = shared_path(spark, "served")
    train_for_serving(txn(spark, sf_dir), _CELL_ROLES, path, "txn_id", cell_bagging(), calendar=False)
    return _shown_metrics(load_report(spark, path, "metrics"))


def _small_served(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a served model with three shallow trees on all columns."""
    path = shared_path(spark, "served")
    roles = ColumnRoles(target=TARGET, kind=KIND, date=DATE, numeric=(AREA, PARKING), categorical=tuple(CATEGORICAL))
    bagging = BaggingRegressor(numEstimators=3, maxDepth=4, seed=SEED, keyCol=["txn_id"])
    train_for_serving(txn(spark, sf_dir), roles, path, "txn_id", bagging, zero_fill=(PARKING,))
    return path


@query(with_ctes("kept", extra="""counted AS (SELECT [(SELECT count(*) FROM txn), (SELECT count(*) FROM txn WHERE upper(trim(trans_group)) = 'SALES'),
  (SELECT count(*) FROM sales), (SELECT count(*) FROM kept),
  (SELECT count(*) FROM kept WHERE try_strptime(instance_date, '%d-%m-%Y') IS NOT NULL)] AS c),
steps AS (SELECT ['transaction kind', 'deduplicate', 'price range', 'target and date', 'feature vector'] AS s)""",
    select="""SELECT CAST(i AS INT) AS step_no, s[i] AS step, c[i] AS rows_in, c[least(i + 1, 5)] AS rows_out,
  round(c[least(i + 1, 5)] * 100.0 / c[i], 2) AS kept_pct, round(c[least(i + 1, 5)] * 100.0 / c[1], 2) AS kept_of_raw_pct
  FROM range(1, 6) AS r(i), counted, steps"""))
def cleaning_audit_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by each step of the serving job, counted while it wrote them."""
    return load_report(spark, _small_served(spark, sf_dir), "audit")


@query(with_ctes("sales", select=f"""SELECT CAST(i AS INT) AS position, f[i] AS feature, 'actual_worth' AS target, 'area_name,property_usage,property_type' AS categorical,
  'forest' AS engine, CAST(3 AS INT) AS trees, CAST(4 AS INT) AS depth, CAST({SEED} AS BIGINT) AS seed
  FROM range(1, 10) AS r(i), (SELECT ['procedure_area', 'has_parking', 'trans_year', 'trans_month', 'trans_quarter', 'trans_dayofweek',
    'area_name_indexed', 'property_usage_indexed', 'property_type_indexed'] AS f)"""))
def serving_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings a scoring job reads from the published version."""
    settings = load_report(spark, _small_served(spark, sf_dir), "settings")
    return settings.select(
        F.posexplode("features").alias("place", "feature"), "target", F.array_join("categorical", ",").alias("categorical"), "engine",
        F.col("numEstimators").alias("trees"), F.col("maxDepth").alias("depth"), "seed",
    ).select((F.col("place") + 1).alias("position"), "feature", "target", "categorical", "engine", "trees", "depth", "seed")


@query(with_ctes("kept", extra=f"""rows_ AS (SELECT txn_id, coalesce(area_name, 'Unknown') AS area_name, property_type, coalesce(has_parking, 0) AS parking,
  actual_worth AS label FROM kept WHERE try_strptime(instance_date, '%d-%m-%Y') IS NOT NULL AND {in_train_sql()}),
drawn AS (SELECT r.*, i, {poisson_sql(f"concat('{SEED}:', i)")} AS w FROM rows_ r, range({TREES}) AS draws(i)),
cells AS (SELECT area_name, property_type, parking, avg(mean_i) AS price FROM (SELECT area_name, property_type, parking, i,
  sum(w * label) / sum(w) AS mean_i FROM drawn GROUP BY ALL) GROUP BY ALL)""",
    select="""SELECT txn_id, round(price, 2) AS predicted_price, CAST(NULL AS VARCHAR) AS unscored_reason FROM txn JOIN cells
  ON coalesce(txn.area_name, 'Unknown') = cells.area_name AND txn.property_type = cells.property_type AND coalesce(txn.has_parking, 0) = cells.parking"""))
def serving_job_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of a published model for all requests; missing categories and numbers are filled as they were in training."""
    path = shared_path(spark, "served")
    roles = ColumnRoles(target=TARGET, kind=KIND, date=DATE, numeric=(PARKING,), categorical=tuple(CELL))
    train_for_serving(txn(spark, sf_dir), roles, path, "txn_id", cell_bagging(), calendar=False, zero_fill=(PARKING,))
    model, _ = load_served(spark, path)
    return rounded(score(txn(spark, sf_dir), model, AREA).select("txn_id", "predicted_price", "unscored_reason"), 2, "predicted_price")


_PARSED = "try_strptime(instance_date, '%d-%m-%Y')"


@query(with_ctes("txn", select=f"""SELECT txn_id, CASE WHEN {_PARSED} IS NULL THEN 'trans_year' END AS unscored_reason,
  {_PARSED} IS NOT NULL AS in_range FROM txn"""))
def serving_job_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard settings end to end: train, store, load, score every request.

    Each request comes back with a price inside the range of the training labels, or with the input it lacks.
    """
    path = shared_path(spark, "served")
    roles = ColumnRoles(target=TARGET, kind=KIND, date=DATE, numeric=(AREA, PARKING), categorical=tuple(CATEGORICAL))
    train_for_serving(txn(spark, sf_dir), roles, path, "txn_id", zero_fill=(PARKING,))
    model, _ = load_served(spark, path)
    dated = CalendarFeatures(dateCol=DATE).transform(clean_for_serving(txn(spark, sf_dir), TARGET, KIND))
    low, high = dated.filter("trans_year is not null").agg(F.min(TARGET), F.max(TARGET)).first()
    inside = F.coalesce(F.col("predicted_price").between(low, high), F.lit(False))
    return score(txn(spark, sf_dir), model, AREA).select("txn_id", "unscored_reason", inside.alias("in_range"))
