"""Regression metrics, their summary over folds, and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def regression_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """RMSE, MAE, R2 and MAPE of all groups in one aggregate.

    Rows without a label or a prediction count in none of them. MAPE (percent) is over non-zero labels and 0.0 when there are none;
    ``n_nonzero`` tells the two apart. R2 is NULL when the label is constant.
    """
    error = F.col(label) - F.col(prediction)
    actual = F.when(error.isNotNull(), F.col(label))
    squared = F.sum(error * error)
    n = F.count(error)
    ratio = F.when(actual != 0, F.abs(error / actual) * 100)
    return df.groupBy(*by).agg(
        n.alias("n_rows"),
        F.sqrt(squared / n).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squared, F.var_pop(actual) * n)).alias("r2"),
        F.coalesce(F.avg(ratio), F.lit(0.0)).alias("mape"),
        F.count(ratio).alias("n_nonzero"),
    )


def evaluate(model, test: DataFrame, label: str = "label", prediction: str = "prediction"):
    """(predictions, one-row metrics) of a fitted model."""
    predictions = model.transform(test)
    return predictions, regression_metrics(predictions, (), label, prediction)


def cv_summary(fold_metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation over folds of rmse, mae and r2."""
    aggregates = [F.count(F.lit(1)).alias("folds")]
    for metric in ("rmse", "mae", "r2"):
        aggregates += [
            F.avg(metric).alias(f"{metric}_mean"),
            F.stddev_pop(metric).alias(f"{metric}_std"),
        ]
    return fold_metrics.groupBy(*by).agg(*aggregates)


def model_comparison(results: DataFrame) -> DataFrame:
    """Models from best to worst R2 with display text.

    Takes a CV summary (shown as mean ± deviation) or plain metrics per model.
    """
    spread = "rmse_mean" in results.columns

    def shown(metric: str, decimals: int) -> Column:
        if not spread:
            return F.format_number(metric, decimals)
        return F.concat(
            F.format_number(f"{metric}_mean", decimals),
            F.lit(" ± "),
            F.format_number(f"{metric}_std", decimals),
        )

    def value(metric: str) -> Column:
        return F.col(f"{metric}_mean" if spread else metric)

    return results.select(
        "model",
        shown("rmse", 0).alias("rmse_text"),
        shown("mae", 0).alias("mae_text"),
        shown("r2", 4).alias("r2_text"),
        value("rmse").alias("rmse"),
        value("mae").alias("mae"),
        value("r2").alias("r2"),
    ).orderBy(F.desc("r2"), "model")
