"""Calendar parts, category codes, indicator vectors, feature vectors, scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.operators.codes import code_dictionary, encode_stored
from tabreg.operators.features import (
    CalendarFeatures,
    category_indexer,
    coded,
    engineer_features,
    feature_pipeline,
    one_hot_encoder,
    scaler,
)
from tabreg.plans import clean, clean_for_serving, serving_features
from tabreg.sources import stage

from .fixture import (
    AREA, CATEGORICAL, DATE, KIND, NUMERIC, PARKING, TARGET, txn, with_ctes,
)
from .registry import query, rounded

_SLOTS = [*NUMERIC, "trans_year", "trans_month", "trans_quarter", "trans_dayofweek", *coded(CATEGORICAL)]


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = clean(txn(spark, sf_dir), TARGET, KIND)
    return rows


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows with the full feature vector and label."""
    rows, _, _ = engineer_features(clean_rows(spark, sf_dir), NUMERIC, CATEGORICAL, DATE, TARGET)
    return rows


def _spread(df: DataFrame, vector: str, decimals: int) -> DataFrame:
    """Vector slots as columns f0, f1, ..."""
    values = vector_to_array(vector)
    return df.select(
        "txn_id", *[F.round(values[i], decimals).alias(f"f{i}") for i in range(len(_SLOTS))]
    )


@query(with_ctes("txn", extra="""p AS (SELECT txn_id, CAST(try_strptime(instance_date, '%d-%m-%Y') AS DATE) AS d FROM txn)""",
    select="""SELECT txn_id, CAST(year(d) AS INT) AS trans_year, CAST(month(d) AS INT) AS trans_month,
  CAST(quarter(d) AS INT) AS trans_quarter, CAST(dayofweek(d) + 1 AS INT) AS trans_dayofweek,
  dayofweek(d) IN (0, 6) AS is_weekend FROM p"""))
def temporal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = CalendarFeatures(dateCol=DATE, weekendDays=[1, 7]).transform(txn(spark, sf_dir))
    return dated.select("txn_id", "trans_year", "trans_month", "trans_quarter", "trans_dayofweek", "is_weekend")


_CODES = ",\n".join(
    f"""k_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS code
  FROM txn WHERE {c} IS NOT NULL GROUP BY {c})""" for c in CATEGORICAL
)
_CODE_COLUMNS = ", ".join(
    f"coalesce(k_{c}.code, (SELECT CAST(count(*) AS DOUBLE) FROM k_{c})) AS {c}_indexed" for c in CATEGORICAL
)
_CODE_JOINS = " ".join(f"LEFT JOIN k_{c} ON txn.{c} = k_{c}.{c}" for c in CATEGORICAL)


@query(with_ctes("txn", extra=_CODES, select=f"SELECT txn_id, {_CODE_COLUMNS} FROM txn {_CODE_JOINS}"))
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return category_indexer(CATEGORICAL).fit(rows).transform(rows).select("txn_id", *coded(CATEGORICAL))


@query(with_ctes("txn", extra=_CODES, select=f"SELECT txn_id, {_CODE_COLUMNS} FROM txn {_CODE_JOINS}"))
def string_index_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same codes from a stored dictionary, by joins."""
    rows = stage(txn(spark, sf_dir), "txn")
    return encode_stored(rows, code_dictionary(rows, CATEGORICAL), CATEGORICAL).select("txn_id", *coded(CATEGORICAL))


@query(with_ctes("txn", extra=_CODES, select=f"""SELECT txn_id, {_CODE_COLUMNS} FROM txn {_CODE_JOINS}
  WHERE txn.area_name IS NOT NULL"""))
def string_index_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    indexer = category_indexer(CATEGORICAL, handle_invalid="skip")
    return indexer.fit(rows).transform(rows).select("txn_id", *coded(CATEGORICAL))


@query(with_ctes("txn", extra=_CODES, select="SELECT txn_id, " + ", ".join(
    f"CAST(coalesce(k_{c}.code, (SELECT count(*) FROM k_{c})) AS BIGINT) AS {c}_slot, "
    f"(SELECT count(*) + 1 FROM k_{c}) AS {c}_size" for c in CATEGORICAL) + f" FROM txn {_CODE_JOINS}"))
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    rows = category_indexer(CATEGORICAL).fit(rows).transform(rows)
    encoded = one_hot_encoder(CATEGORICAL).fit(rows).transform(rows)
    shown = []
    for c in CATEGORICAL:
        slots = vector_to_array(f"{c}_onehot")
        shown += [
            (F.array_position(slots, 1.0) - 1).alias(f"{c}_slot"),
            F.size(slots).cast("long").alias(f"{c}_size"),
        ]
    return encoded.select("txn_id", *shown)


def _vector_sql(expression: str, source: str = "coded", extra: str = "") -> str:
    columns = ", ".join(
        f"round({expression.format(c=c)}, 6) AS f{i}" for i, c in enumerate(_SLOTS)
    )
    return f"SELECT txn_id, {columns}{extra} FROM {source}"


@query(with_ctes("coded", select=_vector_sql("CAST({c} AS DOUBLE)", extra=", label")))
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feature_rows(spark, sf_dir)
    values = vector_to_array("features")
    slots = [F.round(values[i], 6).alias(f"f{i}") for i in range(len(_SLOTS))]
    return rows.select("txn_id", *slots, "label")


@query(with_ctes("coded", select=_vector_sql("({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()")))
def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feature_rows(spark, sf_dir)
    return _spread(scaler("standard").fit(rows).transform(rows), "scaled_features", 6)


@query(with_ctes("coded", select=_vector_sql("CAST({c} - min({c}) OVER () AS DOUBLE) / (max({c}) OVER () - min({c}) OVER ())")))
def scale_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feature_rows(spark, sf_dir)
    return _spread(scaler("minmax").fit(rows).transform(rows), "scaled_features", 6)


@query(with_ctes("coded", select=_vector_sql("{c} / stddev_samp({c}) OVER ()")))
def feature_pipeline_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_rows(spark, sf_dir)
    pipeline = feature_pipeline(NUMERIC, CATEGORICAL, DATE, TARGET, scaling="standard")
    return _spread(pipeline.fit(rows).transform(rows), "scaled_features", 6)


@query(with_ctes("kept", extra="""s_fill AS (SELECT avg(procedure_area) AS area_mean FROM kept),
s AS (SELECT txn_id, CAST(try_strptime(instance_date, '%d-%m-%Y') AS DATE) AS d,
  coalesce(area_name, 'Unknown') AS area_name, property_usage, property_type,
  round(coalesce(procedure_area, area_mean), 6) AS procedure_area, coalesce(has_parking, 0) AS has_parking,
  actual_worth AS label FROM kept, s_fill)""",
    select="""SELECT txn_id, area_name, property_usage, property_type, procedure_area, has_parking, label,
  CAST(year(d) AS INT) AS trans_year, CAST(month(d) AS INT) AS trans_month, CAST(quarter(d) AS INT) AS trans_quarter,
  CAST(dayofweek(d) + 1 AS INT) AS trans_dayofweek FROM s WHERE d IS NOT NULL"""))
def feature_table_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean_for_serving(txn(spark, sf_dir), TARGET, KIND)
    rows, _ = serving_features(kept, TARGET, DATE, [AREA], [PARKING], CATEGORICAL)
    return rounded(rows, 6, AREA).select(
        "txn_id", *CATEGORICAL, AREA, PARKING, "label",
        "trans_year", "trans_month", "trans_quarter", "trans_dayofweek",
    )
