"""Trees on codes alone, grown from cells: training rows with equal features stand as one weighted row.

A regression tree looks at a row's features, label and weight only. Rows with equal features go the same way at
every split, so their mean label under their summed weight gives the same gains and the same leaves: what labels vary by
inside a cell is on both sides of each gain. A pass over the rows gives the cells of all folds and all bootstrap draws,
and fits read these. Only vectors of codes are taken, whose split candidates do not depend on a sample of the rows, and
learners that do not count rows in nodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, functions as F

from .features import largest_arity, vector_attributes

DRAW, ROWS, WEIGHT = "__draw", "__rows", "__weight"


def grows_from_cells(df: DataFrame, features_col: str, min_instances: int) -> bool:
    """Whether trees on this vector column come out the same from cells."""
    attributes = vector_attributes(df, features_col) if features_col in df.columns else []
    return min_instances == 1 and bool(attributes) and all(a.get("num_vals") or a.get("vals") for a in attributes)


def is_cell_tree(df: DataFrame, estimator) -> bool:
    """Whether the estimator is a single unweighted tree that ``grow`` can fit."""
    return (
        type(estimator) is DecisionTreeRegressor and not estimator.isDefined("weightCol")
        and estimator.getOrDefault("labelCol") in df.columns
        and grows_from_cells(df, estimator.getOrDefault("featuresCol"), estimator.getOrDefault("minInstancesPerNode"))
    )


def cells(df: DataFrame, features_col: str, label_col: str, weights: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """(*by, features, draw, rows, weight, label) of each cell under each of ``weights``, by one aggregate; empty ones are left out.

    A label that is missing stays an error of the fit: it makes its cell's label NaN.
    """
    label = F.coalesce(F.col(label_col).cast("double"), F.lit(float("nan")))
    named = df.select(*by, features_col, label.alias("__label"), *[w.cast("double").alias(f"__w{i}") for i, w in enumerate(weights)])
    found, sums = [], []
    for i in range(len(weights)):
        w = F.col(f"__w{i}")
        sums += [F.count_if(w > 0).alias(f"n{i}"), F.sum(w).alias(f"w{i}"), F.sum(F.when(w > 0, w * F.col("__label"))).alias(f"s{i}")]
        found.append(F.struct(
            F.lit(i).alias(DRAW), F.col(f"n{i}").alias(ROWS), F.col(f"w{i}").alias(WEIGHT), (F.col(f"s{i}") / F.col(f"w{i}")).alias(label_col),
        ))
    grouped = named.groupBy(*by, features_col).agg(*sums)
    features = F.col(features_col).alias(features_col, metadata=df.schema[features_col].metadata)
    return grouped.select(*by, features, F.explode(F.filter(F.array(*found), lambda c: c[ROWS] > 0)).alias("c")).select(*by, features_col, "c.*")


def grow(found: DataFrame, tree: DecisionTreeRegressor, draw: int = 0):
    """``tree`` fitted to the cells of one draw."""
    mine = found.filter(F.col(DRAW) == draw)
    least = largest_arity(found, tree.getOrDefault("featuresCol"))
    if mine.count() < least:
        # the learner asks for as many rows as there are categories: cells are dealt out to copies, at most one for each of their rows
        mine = mine.withColumn("__copies", F.least(F.col(ROWS), F.lit(least)).cast("int")).withColumns({
            WEIGHT: F.col(WEIGHT) / F.col("__copies"), "__copies": F.explode(F.sequence(F.lit(1), F.col("__copies"))),
        })
    return tree.copy({tree.weightCol: WEIGHT}).fit(mine)
