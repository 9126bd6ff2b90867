"""Profiles: missing values, summaries, quantiles, dictionaries, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.functions import numeric_columns
from tabreg.operators.arrivals import FileProfile
from tabreg.operators.clean import OutlierFilter, of_kind
from tabreg.operators.profile import (
    category_dictionary,
    describe,
    first_rows,
    missing_counts,
    missing_report,
    retention_audit,
    schema_rows,
    table_counts,
)
from tabreg.operators.quantiles import approx_quantiles, exact_quantiles
from tabreg.plans import sales_rows
from tabreg.sources import shared_path

from .fixture import AREA, CATEGORICAL, COLUMNS, KIND, TARGET, txn, txn_nan, with_ctes
from .registry import query, rounded

_TYPES = {
    "txn_id": "long", "has_parking": "integer",
    "procedure_area": "double", "sparse_value": "double", "actual_worth": "double", "nan_area": "double",
}


def _missing_sql(column: str) -> str:
    nan = " OR isnan(nan_area)" if column == "nan_area" else ""
    return f"count(*) FILTER (WHERE {column} IS NULL{nan})"


_NAN_COLUMNS = [*COLUMNS, "nan_area"]
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_missing_sql(c)} AS missing_count, "
    f"round({_missing_sql(c)} * 100.0 / count(*), 2) AS missing_pct, '{_TYPES.get(c, 'string')}' AS dtype FROM txn_nan"
    for c in _NAN_COLUMNS
)


@query(with_ctes("txn_nan", select="SELECT " + ", ".join(f"{_missing_sql(c)} AS {c}" for c in _NAN_COLUMNS) + " FROM txn_nan"))
def profile_missing_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_counts(txn_nan(spark, sf_dir))


@query(with_ctes("txn_nan", select=_MISSING))
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_report(txn_nan(spark, sf_dir))


@query(with_ctes("txn_nan", select=f"SELECT * FROM ({_MISSING}) WHERE missing_count > 0"))
def profile_missing_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_report(txn_nan(spark, sf_dir), only_missing=True)


def _describe_sql(c: str) -> str:
    if c in _TYPES:
        numbers = f"round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS stddev, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value"
        texts = "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
    else:
        numbers = "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value"
        texts = f"min({c}) AS min_text, max({c}) AS max_text"
    return f"SELECT '{c}' AS column_name, count({c}) AS value_count, {numbers}, {texts} FROM txn"


@query(with_ctes("txn", select=" UNION ALL ".join(_describe_sql(c) for c in COLUMNS)))
def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe(txn(spark, sf_dir)), 2, "mean", "stddev")


@query(with_ctes("txn", select=f"SELECT count(*) AS row_count, CAST({len(COLUMNS)} AS BIGINT) AS column_count FROM txn"))
def profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts(txn(spark, sf_dir))


_NAMES = "{'VARCHAR': 'string', 'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double'}"


@query(with_ctes("txn", extra="t AS (SELECT * FROM txn LIMIT 1)", select=" UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{c}' AS column_name, MAP {_NAMES}[typeof({c})] AS dtype, true AS nullable FROM t" for i, c in enumerate(COLUMNS, 1))))
def profile_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema as rows, of the table as stored."""
    path = shared_path(spark, "schema")
    txn(spark, sf_dir).write.parquet(path)
    return schema_rows(spark.read.parquet(path))


@query(with_ctes("txn", select=f"""SELECT column_name, missing_count, missing_pct, value_count, mean, stddev, min_value, max_value, min_text, max_text
  FROM ({" UNION ALL ".join(_describe_sql(c) for c in COLUMNS)}) JOIN ({_MISSING.replace("txn_nan", "txn").replace(" OR isnan(nan_area)", "").split(" UNION ALL SELECT 'nan_area'")[0]}) USING (column_name)"""))
def profile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile merged from states of files that arrived in two deliveries; the second refresh reads the second one only."""
    files, states = shared_path(spark, "deliveries"), shared_path(spark, "states")
    rows = txn(spark, sf_dir)
    profile = FileProfile(spark, states, files)
    for part in (rows.filter("txn_id % 3 = 0"), rows.filter("txn_id % 3 <> 0")):
        part.write.mode("append").parquet(files)
        profile.refresh()
    report = profile.missing_report().drop("dtype").join(profile.describe().drop("approx_median", "approx_distinct"), "column_name")
    return rounded(report, 2, "mean", "stddev")


@query(with_ctes("txn", select="SELECT * FROM txn ORDER BY txn_id LIMIT 5"))
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(txn(spark, sf_dir), ["txn_id"], 5)


_AUDIT = """counts AS (SELECT (SELECT count(*) FROM txn) AS raw,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM txn)) AS dedup,
  (SELECT count(*) FROM sales) AS sales, (SELECT count(*) FROM kept) AS kept),
steps AS (SELECT 1 AS step_no, 'deduplicate' AS step, raw AS rows_in, dedup AS rows_out, raw FROM counts
  UNION ALL SELECT 2, 'kind', dedup, sales, raw FROM counts
  UNION ALL SELECT 3, 'price range', sales, kept, raw FROM counts)"""


@query(with_ctes("kept", extra=_AUDIT, select="""SELECT CAST(step_no AS INT) AS step_no, step, rows_in, rows_out,
  round(rows_out * 100.0 / rows_in, 2) AS kept_pct, round(rows_out * 100.0 / raw, 2) AS kept_of_raw_pct FROM steps"""))
def cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    bounds = OutlierFilter(inputCol=TARGET, factor=3.0).fit(sales_rows(rows, KIND))
    return retention_audit(rows, {"kind": of_kind(KIND), "price range": bounds.accepts()})


_PROBABILITIES = [0.01, 0.25, 0.5, 0.75, 0.99]


def _quantile_frame(spark: SparkSession, values: dict) -> DataFrame:
    rows = [(c, p, float(v)) for c, found in values.items() for p, v in zip(_PROBABILITIES, found)]
    return spark.createDataFrame(rows, "column_name string, probability double, value double")


def _quantile_sql(function: str) -> str:
    return with_ctes("txn", select=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability, CAST({function}({c}, {p}) AS DOUBLE) AS value FROM txn"
        for c in ("procedure_area", "sparse_value", "actual_worth") for p in _PROBABILITIES
    ))


@query(_quantile_sql("quantile_disc"))
def quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quantile_frame(spark, exact_quantiles(txn(spark, sf_dir), [AREA, "sparse_value", TARGET], _PROBABILITIES))


_INFINITE = "CASE WHEN txn_id % 7 = 0 THEN CAST('-inf' AS DOUBLE) WHEN txn_id % 11 = 0 THEN CAST('inf' AS DOUBLE) ELSE actual_worth END"


@query(with_ctes("txn", extra=f"v AS (SELECT {_INFINITE} AS v FROM txn)", select=" UNION ALL ".join(
    f"SELECT 'v' AS column_name, CAST({p} AS DOUBLE) AS probability, quantile_disc(v, {p}) AS value FROM v" for p in _PROBABILITIES)))
def quantiles_infinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infinite values are values: ranks among them, and between them and the others."""
    endless = F.when(F.col("txn_id") % 7 == 0, F.lit(float("-inf"))).when(F.col("txn_id") % 11 == 0, F.lit(float("inf"))).otherwise(F.col(TARGET))
    return _quantile_frame(spark, exact_quantiles(txn(spark, sf_dir).select(endless.alias("v")), "v", _PROBABILITIES))


@query(with_ctes("txn", select=_quantile_sql("quantile_cont").split("\n")[-1]
    .replace("CAST(quantile_cont", "round(CAST(quantile_cont").replace(" AS DOUBLE) AS value", " AS DOUBLE), 4) AS value")))
def quantiles_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_quantiles(txn(spark, sf_dir), [AREA, "sparse_value", TARGET], _PROBABILITIES, interpolate=True)
    return rounded(_quantile_frame(spark, found), 4, "value")


@query(with_ctes("txn", select=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS probability, count({c}) AS value_count, true AS within_error FROM txn"
    for c in ("procedure_area", "sparse_value", "actual_worth") for p in _PROBABILITIES)))
def quantiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each approximate quantile lies within 1 % of its rank, counted on all rows."""
    rows, error = txn(spark, sf_dir), 0.01
    found = approx_quantiles(rows, [AREA, "sparse_value", TARGET], _PROBABILITIES, error)
    triples = [(c, p, v) for c, values in found.items() for p, v in zip(_PROBABILITIES, values)]
    counted = rows.agg(*[
        F.struct(
            F.count(c).alias("n"),
            F.count_if(F.col(c) < v).alias("below"),
            F.count_if(F.col(c) <= v).alias("up_to"),
        ).alias(f"q{i}")
        for i, (c, _, v) in enumerate(triples)
    ])
    checks = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(p).alias("probability"),
            F.col(f"q{i}.n").alias("value_count"),
            (
                (F.col(f"q{i}.below") <= F.ceil(F.lit(p + error) * F.col(f"q{i}.n")))
                & (F.col(f"q{i}.up_to") >= F.floor(F.lit(p - error) * F.col(f"q{i}.n")))
            ).alias("within_error"),
        )
        for i, (c, p, _) in enumerate(triples)
    ]
    return counted.select(F.explode(F.array(*checks)).alias("r")).select("r.*")


@query(with_ctes("sales", select=" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM sales WHERE {c} IS NOT NULL" for c in CATEGORICAL)))
def category_dictionary_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sales_rows(txn(spark, sf_dir).select(*COLUMNS), KIND, staged=False)
    return category_dictionary(sales, CATEGORICAL)


@query(with_ctes("txn", select=" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM txn WHERE {c} IS NOT NULL" for c in CATEGORICAL)
    + " ORDER BY column_name, value"), name="category_dictionary")
def category_dictionary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_dictionary(txn(spark, sf_dir), CATEGORICAL).orderBy("column_name", "value")
