"""``txn``: property-like transactions with dirt, derived from the star schema.

Both twins produce the same rows. The dirt (NULLs, unparseable dates, mixed
case, repeated rows, outliers, a sparse column) follows from the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Column roles of the fixture.
TARGET, KIND, DATE, AREA, PARKING = "actual_worth", "trans_group", "instance_date", "procedure_area", "has_parking"
CATEGORICAL = ["area_name", "property_usage", "property_type"]
NUMERIC = [AREA, PARKING]
COLUMNS = ["txn_id", KIND, DATE, *CATEGORICAL, AREA, PARKING, "sparse_value", TARGET]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("qty"))
    )
    # nation has 25 rows at every scale.
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = (
        table(spark, sf_dir, "orders")
        .join(quantity, "o_orderkey", "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    price = F.lit(0.05) * F.col("o_totalprice") + F.lit(1500.0) * F.coalesce("qty", F.lit(10.0)) * (
        1 + F.col("n_regionkey")
    )
    copies = F.when(key % 50 == 0, 2).otherwise(1)
    return orders.select(
        key.alias("txn_id"),
        F.when(status == "F", "Sales").when(status == "O", " sales ").otherwise("Mortgages").alias(KIND),
        F.when(key % 97 == 0, "Unknown")
        .when(key % 89 == 0, None)
        .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
        .alias(DATE),
        F.when(key % 31 != 0, F.col("n_name")).alias("area_name"),
        F.col("c_mktsegment").alias("property_usage"),
        F.col("o_orderpriority").alias("property_type"),
        F.col("qty").alias(AREA),
        F.when(key % 13 != 0, (key % 2).cast("int")).alias(PARKING),
        F.when(key % 10 >= 6, F.col("o_totalprice")).alias("sparse_value"),
        F.when(key % 211 != 0, price * F.when(key % 101 == 0, 40.0).otherwise(1.0)).alias(TARGET),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def txn_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``txn`` with a further column that also holds NaN."""
    nan = F.when(F.col("txn_id") % 23 == 0, F.lit(float("nan"))).otherwise(F.col(AREA))
    return txn(spark, sf_dir).withColumn("nan_area", nan)


# Common table expressions of the SQL twins; each lists what it builds on.
CTES = {
    "txn": (
        [],
        """q AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey),
b AS (SELECT o_orderkey AS txn_id,
  CASE o_orderstatus WHEN 'F' THEN 'Sales' WHEN 'O' THEN ' sales ' ELSE 'Mortgages' END AS trans_group,
  CASE WHEN o_orderkey % 97 = 0 THEN 'Unknown' WHEN o_orderkey % 89 = 0 THEN NULL
       ELSE strftime(o_orderdate, '%d-%m-%Y') END AS instance_date,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE n_name END AS area_name,
  c_mktsegment AS property_usage, o_orderpriority AS property_type,
  qty AS procedure_area,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS INT) END AS has_parking,
  CASE WHEN o_orderkey % 10 < 6 THEN NULL ELSE o_totalprice END AS sparse_value,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL
       ELSE (CAST(0.05 AS DOUBLE) * o_totalprice + CAST(1500 AS DOUBLE) * coalesce(qty, 10.0) * (1 + n_regionkey))
            * CAST(CASE WHEN o_orderkey % 101 = 0 THEN 40 ELSE 1 END AS DOUBLE) END AS actual_worth
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN q ON l_orderkey = o_orderkey),
txn AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE txn_id % 50 = 0)""",
    ),
    "txn_nan": (
        ["txn"],
        """txn_nan AS (SELECT *, CASE WHEN txn_id % 23 = 0 THEN CAST('NaN' AS DOUBLE)
  ELSE procedure_area END AS nan_area FROM txn)""",
    ),
    "sales": (
        ["txn"],
        "sales AS (SELECT DISTINCT * FROM txn WHERE upper(trim(trans_group)) = 'SALES')",
    ),
    "kept": (
        ["sales"],
        """quartiles AS (SELECT quantile_disc(actual_worth, 0.25) AS q1,
  quantile_disc(actual_worth, 0.75) AS q3 FROM sales),
bounds AS (SELECT greatest(CAST(0 AS DOUBLE), q1 - 3.0 * (q3 - q1)) AS lo, q3 + 3.0 * (q3 - q1) AS hi FROM quartiles),
kept AS (SELECT sales.* FROM sales, bounds WHERE actual_worth BETWEEN lo AND hi)""",
    ),
    # sparse_value is missing in over half of the rows at every scale, so it is dropped.
    "clean": (
        ["kept"],
        """fills AS (SELECT avg(procedure_area) AS area_mean, CAST(trunc(avg(has_parking)) AS INT) AS parking_mean FROM kept),
clean AS (SELECT txn_id, trans_group, coalesce(instance_date, 'Unknown') AS instance_date,
  coalesce(area_name, 'Unknown') AS area_name, property_usage, property_type,
  coalesce(procedure_area, area_mean) AS procedure_area,
  coalesce(has_parking, parking_mean) AS has_parking, actual_worth FROM kept, fills)""",
    ),
    "dated": (
        ["clean"],
        """parsed AS (SELECT *, CAST(try_strptime(instance_date, '%d-%m-%Y') AS DATE) AS d FROM clean),
dated AS (SELECT * EXCLUDE (d), CAST(year(d) AS INT) AS trans_year, CAST(month(d) AS INT) AS trans_month,
  CAST(quarter(d) AS INT) AS trans_quarter, CAST(dayofweek(d) + 1 AS INT) AS trans_dayofweek FROM parsed)""",
    ),
    "coded": (
        ["dated"],
        ",\n".join(
            f"""d_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS {c}_indexed
  FROM dated GROUP BY {c})"""
            for c in CATEGORICAL
        )
        + """,
coded AS (SELECT dated.*, area_name_indexed, property_usage_indexed, property_type_indexed,
  actual_worth AS label FROM dated JOIN d_area_name USING (area_name)
  JOIN d_property_usage USING (property_usage) JOIN d_property_type USING (property_type)
  WHERE trans_year IS NOT NULL)""",
    ),
}


def with_ctes(*names: str, extra: str = "", select: str) -> str:
    """SQL text: the named CTEs and what they build on, further ones, and the final SELECT."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in CTES[name][0]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [CTES[n][1] for n in ordered] + ([extra] if extra else [])
    return "WITH " + ",\n".join(parts) + "\n" + select


def bucket_sql(key: str, seed: str) -> str:
    """The SQL twin of ``hash_bucket``; ``seed`` is an SQL string expression."""
    return f"CAST(concat('0x', substr(md5(concat({seed}, ':', {key})), 1, 15)) AS BIGINT)"
