"""The data behind model and price charts, as tables over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import equal_width_bin, hash_bucket
from ..functions.hashing import BUCKETS
from .quantiles import quantiles


def with_residual(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(prediction) - F.col(label))


def residual_summary(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    probabilities=(0.05, 0.25, 0.5, 0.75, 0.95),
    relative_error: float = 0.0,
) -> DataFrame:
    """One row: count, mean, stddev, min, max and quantiles of prediction - label."""
    residuals = with_residual(df, label, prediction).select("residual")
    values = quantiles(residuals, "residual", probabilities, relative_error)["residual"]
    r = F.col("residual")
    return residuals.agg(
        F.count(r).alias("n_rows"),
        F.avg(r).alias("mean"),
        F.stddev(r).alias("stddev"),
        F.min(r).alias("min_value"),
        F.max(r).alias("max_value"),
        *[F.lit(v).cast("double").alias(f"p{round(p * 100):02d}") for p, v in zip(probabilities, values)],
    )


def histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """(bin, lower_edge, upper_edge, row_count) of all ``bins`` equal-width bins over the values that are neither NULL nor NaN.

    The edges come from one aggregate, run when this is called.
    """
    values = df.select(value.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    low, high = _edges(values, "v")["v"]
    counted = (
        values.select(equal_width_bin(F.col("v"), low, high, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    # At most `bins` rows on either side.
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / F.lit(bins)
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("lower_edge"),
        (start + (F.col("bin") + 1) * width).alias("upper_edge"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


def bins_2d(df: DataFrame, x: str = "label", y: str = "prediction", bins: int = 20) -> DataFrame:
    """(x_bin, y_bin, row_count) of the non-empty cells: a scatter plot of any number of rows.

    Pairs with a NULL or NaN are left out. The edges of both axes come from one aggregate, run when this is called.
    """
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    edges = _edges(pairs, "x", "y")
    cells = pairs.select(
        *[equal_width_bin(F.col(a), *edges[a], bins).alias(f"{a}_bin") for a in ("x", "y")]
    )
    return cells.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("row_count"))


def _edges(df: DataFrame, *names: str) -> dict[str, tuple[Column, Column]]:
    """Smallest and largest value of each column, as literals."""
    row = df.agg(*[f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max)]).first()
    return {n: tuple(F.lit(row[f"{f.__name__}_{n}"]).cast("double") for f in (F.min, F.max)) for n in names}


def sample_pairs(df: DataFrame, key: str, size: int = 10_000, seed: int = 42) -> DataFrame:
    """About ``size`` rows for plotting, chosen by key hash (all rows when there are fewer).

    The draw has a hash domain of its own, so it is independent of splits and folds with the same seed.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    share = F.least(F.lit(1.0), F.lit(float(size)) / total)
    return df.filter(hash_bucket(key, f"sample:{seed}") < share * F.lit(float(BUCKETS)))


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy("importance_rank").limit(n)
