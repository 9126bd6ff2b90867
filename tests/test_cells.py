from __future__ import annotations

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabreg.functions.hashing import BUCKETS, poisson_count, poisson_cutoffs
from tabreg.operators.cells import cells, grow, grows_from_cells
from tabreg.operators.ensemble import BaggingRegressor
from tabreg.operators.features import category_indexer, feature_assembler
from tabreg.operators.resample import assign_folds, bootstrap_weight, fold_split
from tabreg.plans import cross_validate


@pytest.fixture(scope="module")
def coded_rows(spark):
    """3,000 rows in 35 cells of two codes; keys repeat."""
    raw = spark.range(3000).select(
        (F.col("id") % 2900).alias("id"), F.concat(F.lit("a"), (F.col("id") % 7).cast("string")).alias("a"),
        F.concat(F.lit("b"), (F.col("id") % 5).cast("string")).alias("b"),
        (F.sin("id") * 100 + (F.col("id") % 35) * (F.col("id") % 7)).alias("label"),
    )
    rows = category_indexer(["a", "b"]).fit(raw).transform(raw)
    return feature_assembler([], ["a_indexed", "b_indexed"]).transform(rows).select("id", "features", "label").persist()


@pytest.fixture
def learned_from(monkeypatch):
    """Rows of each table that a tree was fitted to."""
    sizes, fit = [], DecisionTreeRegressor._fit

    def counted(self, dataset):
        sizes.append(dataset.count())
        return fit(self, dataset)

    monkeypatch.setattr(DecisionTreeRegressor, "_fit", counted)
    return sizes


def bagging(**settings):
    return BaggingRegressor(**{**dict(engine="weighted", keyCol=["id"], numEstimators=3, maxDepth=20, seed=7), **settings})


def test_trees_of_all_folds_grow_from_cells(spark, coded_rows, learned_from):
    """Folds, draws and predictions are those of fits to the rows."""
    models = {"tree": DecisionTreeRegressor(maxDepth=20), "bagging": bagging()}
    found = {(r.model, r.id, r.fold, r.label): r.prediction for r in cross_validate(coded_rows, models, "id", k=3).predictions.collect()}
    assert len(learned_from) == 3 + 9 and max(learned_from) <= 2 * 35
    folded = assign_folds(coded_rows, "id", 3)
    for fold in range(3):
        train, validation = fold_split(folded, fold, 3)
        plain = DecisionTreeRegressor(maxDepth=20).fit(train).transform(validation).collect()
        for r in plain:
            assert found["tree", r.id, fold, r.label] == pytest.approx(r.prediction, rel=1e-9)
        trees = [
            DecisionTreeRegressor(maxDepth=20, weightCol="w", seed=7 + i).fit(bootstrap_weight(train, "id", i, 7, column="w", drop_zero=True))
            for i in range(3)
        ]
        for r in validation.collect():
            expected = sum(t.predict(r.features) for t in trees) / 3
            assert found["bagging", r.id, fold, r.label] == pytest.approx(expected, rel=1e-9)


def test_depth_bounds_give_the_same_trees(spark, coded_rows, learned_from):
    """Splits come in the same order: gains do not depend on what labels vary by inside a cell."""
    shallow = bagging(maxDepth=2).fit(coded_rows)
    assert max(learned_from) <= 35
    trees = [
        DecisionTreeRegressor(maxDepth=2, maxBins=256, weightCol="w", seed=7 + i).fit(bootstrap_weight(coded_rows, "id", i, 7, column="w", drop_zero=True))
        for i in range(3)
    ]
    for r in coded_rows.limit(100).collect():
        assert shallow.members[0].predict(r.features) == pytest.approx(trees[0].predict(r.features), rel=1e-9)


def test_few_cells_still_fill_the_learners_bins(spark):
    """Six rows of one cell under a code with five values: as many rows as categories, fewer cells."""
    raw = spark.range(12).select("id", F.concat(F.lit("c"), F.when(F.col("id") < 6, F.col("id") % 5).otherwise(0)).alias("c"), (F.col("id") * 1.0).alias("label"))
    indexed = category_indexer(["c"]).fit(raw).transform(raw)
    rows = feature_assembler([], ["c_indexed"]).transform(indexed).filter("id >= 6").select("id", "features", "label")
    assert bagging().grows_from_cells(rows)
    model = grow(cells(rows, "features", "label", [F.lit(1.0)]), DecisionTreeRegressor())
    assert model.numNodes == 1 and model.predict(rows.first().features) == pytest.approx(8.5)


def test_rows_stay_rows_where_cells_would_differ(spark, coded_rows):
    assert grows_from_cells(coded_rows, "features", 1)
    assert not grows_from_cells(coded_rows, "features", 2)  # a node would count cells
    mixed = feature_assembler(["label"], []).transform(coded_rows.drop("features"))
    assert not grows_from_cells(mixed, "features", 1)  # split candidates come from a sample of the rows


def test_a_missing_label_stays_an_error(spark, coded_rows):
    rows = coded_rows.withColumn("label", F.when(F.col("id") != 5, F.col("label")))
    with pytest.raises(Exception):
        bagging().fit(rows)


def test_predictions_carry_kept_columns(spark, coded_rows):
    rows = coded_rows.withColumn("note", F.col("label") + 1)
    found = cross_validate(rows, DecisionTreeRegressor(), "id", k=3, keep=["note"]).predictions
    assert found.columns == ["model", "fold", "id", "note", "label", "prediction"]
    assert found.filter("note = label + 1").count() == 3000


def test_poisson_draws_stop_at_the_first_cutoff(spark):
    """Same counts as all cut-offs compared, at and around each of them."""
    every = poisson_cutoffs(1.0)
    digits = [f"{d:015x}" for c in every if c < BUCKETS for d in (c - 1, c)] + ["f" * 15, None]
    rows = spark.createDataFrame([(d,) for d in digits], "d string").select("d", poisson_count(F.col("d")).alias("n")).collect()
    for r in rows:
        assert r.n == (None if r.d is None else sum(int(r.d, 16) >= c for c in every if c < BUCKETS))
    assert "CASE WHEN" in poisson_count(F.col("d"))._jc.toString()
