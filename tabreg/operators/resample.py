"""Splits, folds and bootstrap draws that do not depend on the data layout.

All of them are narrow projections or filters over a hash of a row key. The
key must identify rows: rows with equal keys share their fate. ``random=True``
opts into Spark's own sampling, which is quicker to call but changes with the
partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    hash_bucket,
    hash_digits,
    hash_fraction_below,
    poisson_count,
    poisson_positive,
)
from ..sources import stage
from .quantiles import exact_quantiles
from .ranks import row_numbers


def holdout_label(df: DataFrame, key: str | Sequence[str], train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``split``: 'train' or 'test'."""
    in_train = hash_fraction_below(key, seed, train_ratio)
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def holdout_split(
    df: DataFrame,
    key: str | Sequence[str] | None = None,
    train_ratio: float = 0.8,
    seed: int = 42,
    random: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint and complete."""
    if random:
        train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
        return train, test
    in_train = hash_fraction_below(_required(key), seed, train_ratio)
    return df.filter(in_train), df.filter(~in_train)


def assign_folds(
    df: DataFrame,
    key: str | Sequence[str] | None = None,
    k: int = 10,
    seed: int = 42,
    random: bool = False,
) -> DataFrame:
    """Adds ``fold`` in 0..k-1."""
    if k < 2:
        raise ValueError("k must be at least 2")
    if random:
        fold = F.floor(F.rand(seed) * k)
    else:
        fold = hash_bucket(_required(key), seed) % k
    return df.withColumn("fold", fold.cast("int"))


def price_stratum(column: str, edges: Sequence[float]) -> Column:
    """Number of edges below the value; values without a number get the number after the last stratum."""
    value = F.col(f"`{column}`").cast("double")
    number = F.lit(0)
    for edge in edges:
        number = number + (value > F.lit(edge)).cast("int")
    return F.when(value.isNull() | F.isnan(value), F.lit(len(edges) + 1)).otherwise(number)


def assign_stratified_folds(
    df: DataFrame, key: str | Sequence[str], label_col: str, k: int = 10, seed: int = 42, strata: int = 10,
) -> DataFrame:
    """Adds ``stratum`` and ``fold`` in 0..k-1: each fold has the same share of every price range, to one row.

    Strata are cut at exact quantiles of the label; rows without one are a stratum of their own. Inside a stratum rows stand in the order of
    their key's hash and are dealt out in turn, each stratum beginning with another fold. Places come from ``row_numbers``, so a stratum
    that holds most rows is no single task's, and folds depend on keys and labels only, not on the layout.
    """
    if k < 2 or strata < 1:
        raise ValueError("k must be at least 2 and strata at least 1")
    keys = [key] if isinstance(key, str) else list(key)
    stored = stage(df.withColumn("__digits", hash_digits(_required(key), seed)), "stratified")
    edges = exact_quantiles(stored, label_col, [i / strata for i in range(1, strata)], cache=False)[label_col]
    edges = sorted({e for e in edges if e is not None})
    marked = stored.withColumn("stratum", price_stratum(label_col, edges))
    numbered = row_numbers(marked, ["stratum"], ["__digits", *keys], "__place", "__size")
    fold = F.pmod(F.col("__place") + F.col("stratum"), F.lit(k)).cast("int")
    return numbered.withColumn("fold", fold).drop("__digits", "__place", "__size")


def fold_split(df: DataFrame, fold: int, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of one fold."""
    if not 0 <= fold < k:
        raise ValueError(f"fold must be between 0 and {k - 1}")
    return df.filter(F.col("fold") != fold), df.filter(F.col("fold") == fold)


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` and their share in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn(
        "share_pct", F.round(F.try_divide(F.col("row_count") * 100.0, total), 2)
    )


def bootstrap_count(key: str | Sequence[str], draw: int | str = 0, seed: int = 42, fraction: float = 1.0) -> Column:
    """How often a row occurs in bootstrap ``draw``, as an expression; see ``bootstrap_weight``."""
    return poisson_count(hash_digits(key, f"{seed}:{draw}"), fraction)


def bootstrap_weight(
    df: DataFrame,
    key: str | Sequence[str],
    draw: int | str = 0,
    seed: int = 42,
    fraction: float = 1.0,
    column: str = "bootstrap_count",
    drop_zero: bool = False,
) -> DataFrame:
    """Adds how often each row occurs in bootstrap ``draw``: Poisson(fraction).

    The Poisson draw is the large-n limit of sampling with replacement and the
    only form that needs no coordination between partitions. A weight keeps
    the sample at one stored row per source row; ``drop_zero`` leaves out the
    rows that do not occur.
    """
    digits = hash_digits(key, f"{seed}:{draw}")
    if drop_zero:
        df = df.filter(poisson_positive(digits, fraction))
    return df.withColumn(column, poisson_count(digits, fraction))


def bootstrap_rows(
    df: DataFrame,
    key: str | Sequence[str] | None = None,
    draw: int | str = 0,
    seed: int = 42,
    fraction: float = 1.0,
    random: bool = False,
) -> DataFrame:
    """A bootstrap sample as physically repeated rows."""
    if random:
        return df.sample(withReplacement=True, fraction=fraction, seed=seed)
    drawn = bootstrap_weight(df, _required(key), draw, seed, fraction, "__copies", drop_zero=True)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("__copies")))
    return drawn.select(*[F.col(f"`{c}`") for c in df.columns], copies.alias("__copy")).drop("__copy")


def bootstrap_exact(
    df: DataFrame,
    key: str | Sequence[str],
    draw: int | str = 0,
    seed: int = 42,
    fraction: float = 1.0,
    column: str = "bootstrap_count",
) -> DataFrame:
    """Adds how often each row occurs in a sample with replacement of exactly floor(``fraction`` * n) rows of n.

    Rows get dense numbers in the order of their key's hash; the draws are a range, each hashed to a row number, counted, and joined to the rows.
    Numbers are unique, so neither the count nor the join has a frequent key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stored = stage(df.withColumn("__digits", hash_digits(_required(key), seed)), "bootstrap")
    numbered = stage(row_numbers(stored, [], ["__digits", *keys], "__row", "__rows"), "numbered")
    n = stored.count()
    draws = df.sparkSession.range(int(n * fraction)).select(
        (hash_bucket("id", f"{seed}:{draw}:draw") % F.lit(max(n, 1))).alias("__row")
    )
    drawn = draws.groupBy("__row").agg(F.count(F.lit(1)).cast("int").alias("__times"))
    found = numbered.join(drawn, "__row", "left")
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__times", F.lit(0)).alias(column))


def _required(key):
    if not key:
        raise ValueError("name the key columns that identify a row, or pass random=True")
    return key
