"""Holdout split, folds and bootstrap draws from key hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.operators.resample import (
    assign_folds,
    assign_stratified_folds,
    bootstrap_exact,
    bootstrap_rows,
    bootstrap_weight,
    fold_split,
    group_counts,
    holdout_label,
    holdout_split,
)

from tabreg.plans import sales_rows

from .fixture import KIND, TARGET, bucket_sql, txn, with_ctes
from .registry import query

K, SEED, DRAWS = 10, 42, 3
TRAIN_LIMIT = 922337203685477632  # 0.8 of 2^60, as a double

# floor of the Poisson distribution function times 2^60, for k = 0, 1, ... (fixed values)
_CUTOFFS = {
    1.0: [
        424136118829305329, 848272237658610659, 1060340297073263324, 1131029650211480879, 1148701988496035267,
        1152236456152946145, 1152825534095764625, 1152909688087595836, 1152920207336574738, 1152921376142016838,
        1152921493022561048, 1152921503648065067, 1152921504533523735, 1152921504601635940, 1152921504606501098,
        1152921504606825442, 1152921504606845713, 1152921504606846906, 1152921504606846972, 1152921504606846975,
    ],
    0.5: [
        699282240786072831, 1048923361179109246, 1136333641277368350, 1150902021293744868, 1152723068795791932,
        1152905173545996639, 1152920348941847031, 1152921432898693488, 1152921500645996391, 1152921504409735441,
        1152921504597922394, 1152921504606476346, 1152921504606832761, 1152921504606846469, 1152921504606846959,
        1152921504606846975,
    ],
}


def fold_sql(key: str = "txn_id", k: int = K, seed: int = SEED) -> str:
    return f"CAST({bucket_sql(key, repr(str(seed)))} % {k} AS INT)"


def in_train_sql(key: str = "txn_id", seed: int = SEED) -> str:
    return f"{bucket_sql(key, repr(str(seed)))} < {TRAIN_LIMIT}"


def poisson_sql(seed: str, key: str = "txn_id", rate: float = 1.0) -> str:
    """Number of cut-offs reached; ``seed`` is an SQL string expression."""
    bucket = bucket_sql(key, seed)
    return "CAST(" + " + ".join(f"CAST({bucket} >= {c} AS INT)" for c in _CUTOFFS[rate]) + " AS INT)"


_SPLIT = f"SELECT txn_id, CASE WHEN {in_train_sql()} THEN 'train' ELSE 'test' END AS split FROM txn"


@query(with_ctes("txn", select=_SPLIT), name="holdout_split")
def holdout_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = holdout_split(txn(spark, sf_dir), "txn_id")
    return train.select("txn_id", F.lit("train").alias("split")).unionByName(
        test.select("txn_id", F.lit("test").alias("split"))
    )


@query(with_ctes("txn", extra=f"s AS ({_SPLIT})", select="""SELECT split, count(*) AS row_count,
  round(count(*) * 100.0 / (SELECT count(*) FROM s), 2) AS share_pct FROM s GROUP BY split"""))
def split_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_counts(holdout_label(txn(spark, sf_dir), "txn_id"), "split")


@query(with_ctes("txn", select=f"SELECT txn_id, {fold_sql()} AS fold FROM txn"))
def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_folds(txn(spark, sf_dir), "txn_id", K, SEED).select("txn_id", "fold")


@query(with_ctes("txn", extra=f"f AS (SELECT {fold_sql()} AS fold FROM txn)", select="""SELECT fold, count(*) AS row_count,
  round(count(*) * 100.0 / (SELECT count(*) FROM f), 2) AS share_pct FROM f GROUP BY fold ORDER BY fold"""))
def fold_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_counts(assign_folds(txn(spark, sf_dir), "txn_id", K, SEED), "fold").orderBy("fold")


@query(with_ctes("sales", extra=f"""edges AS (SELECT list_sort(list_distinct(quantile_disc(actual_worth, {[i / 10 for i in range(1, 10)]}))) AS e FROM sales),
marked AS (SELECT txn_id, substr(md5(concat('{SEED}:', txn_id)), 1, 15) AS digits, CAST(CASE WHEN actual_worth IS NULL THEN len(e) + 1
  ELSE len(list_filter(e, lambda x: actual_worth > x)) END AS INT) AS stratum FROM sales, edges)""",
    select=f"""SELECT txn_id, stratum, CAST((row_number() OVER (PARTITION BY stratum ORDER BY digits, txn_id) - 1 + stratum) % {K} AS INT) AS fold FROM marked"""))
def kfold_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds with equal shares of ten price ranges; rows without a price are an eleventh."""
    rows = sales_rows(txn(spark, sf_dir), KIND, staged=False)
    return assign_stratified_folds(rows, "txn_id", TARGET, K, SEED).select("txn_id", "stratum", "fold")


@query(with_ctes("txn", select=f"""SELECT txn_id, fold, CASE WHEN fold = 3 THEN 'validation' ELSE 'train' END AS part
  FROM (SELECT txn_id, {fold_sql()} AS fold FROM txn)"""), name="fold_split")
def fold_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = assign_folds(txn(spark, sf_dir).select("txn_id"), "txn_id", K, SEED)
    train, validation = fold_split(folded, 3, K)
    return train.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )


@query(with_ctes("txn", select="SELECT txn_id, " + ", ".join(
    f"{poisson_sql(repr(f'{SEED}:{i}'))} AS draw_{i}" for i in range(DRAWS)) + " FROM txn"))
def bootstrap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir).select("txn_id")
    for i in range(DRAWS):
        rows = bootstrap_weight(rows, "txn_id", i, SEED, column=f"draw_{i}")
    return rows


@query(with_ctes("sales", extra=f"""numbered AS (SELECT txn_id, row_number() OVER (ORDER BY substr(md5(concat('{SEED}:', txn_id)), 1, 15), txn_id) - 1 AS no,
  count(*) OVER () AS n FROM sales),
drawn AS (SELECT {bucket_sql('i', repr(f'{SEED}:0:draw'))} % (SELECT count(*) FROM sales) AS no, count(*) AS times
  FROM (SELECT unnest(range((SELECT count(*) FROM sales))) AS i) GROUP BY 1)""",
    select="SELECT txn_id, CAST(coalesce(times, 0) AS INT) AS bootstrap_count FROM numbered LEFT JOIN drawn USING (no)"), name="bootstrap_exact")
def bootstrap_exact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each row occurs in a sample of exactly as many rows."""
    rows = sales_rows(txn(spark, sf_dir), KIND, staged=False).select("txn_id")
    return bootstrap_exact(rows, "txn_id", 0, SEED)


@query(with_ctes("txn", select=f"""SELECT txn.* FROM txn, unnest(range(CAST({poisson_sql(repr(f'{SEED}:0'))} AS BIGINT))) AS u(n)"""),
       name="bootstrap_rows")
def bootstrap_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap_rows(txn(spark, sf_dir), "txn_id", 0, SEED)


@query(with_ctes("txn", select=f"""SELECT txn_id FROM txn, unnest(range(CAST({poisson_sql(repr(f'{SEED}:5'), rate=0.5)} AS BIGINT))) AS u(n)"""))
def bootstrap_rows_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap_rows(txn(spark, sf_dir).select("txn_id"), "txn_id", 5, SEED, fraction=0.5)
