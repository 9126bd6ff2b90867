from __future__ import annotations

import threading
import time

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tabreg.functions.hashing import BUCKETS, poisson_cutoffs
from tabreg.operators import ensemble, overlap
from tabreg.operators.clean import OutlierFilter
from tabreg.operators.ensemble import BaggingRegressionModel, BaggingRegressor
from tabreg.operators.features import category_indexer, feature_assembler
from tabreg.operators.metrics import cv_summary, model_comparison, regression_metrics
from tabreg.operators.resample import (
    assign_folds,
    bootstrap_rows,
    bootstrap_weight,
    fold_split,
    holdout_split,
)
from tabreg.plans import baseline_models, cross_validate, fit_models, stack_predictions, training
from workload.fixture import txn


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers and a category with many values, with a known relation to the label."""
    raw = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/part.parquet"), F.col("l_partkey") == F.col("p_partkey")
    )
    keyed = raw.groupBy("l_orderkey", "l_linenumber").agg(
        F.max("p_brand").alias("p_brand"), F.max("l_quantity").alias("l_quantity"), F.max("l_extendedprice").alias("label")
    ).limit(4000)
    indexed = category_indexer(["p_brand"]).fit(keyed).transform(keyed)
    return feature_assembler(["l_quantity"], ["p_brand_indexed"]).transform(indexed).persist()


KEY = ["l_orderkey", "l_linenumber"]


def test_splits_are_disjoint_complete_and_layout_free(spark):
    df = spark.range(2000)
    train, test = holdout_split(df, "id", 0.8)
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    assert 0.75 < train.count() / 2000 < 0.85
    again, _ = holdout_split(df.repartition(7), "id", 0.8)
    assert again.exceptAll(train).count() == 0
    assert holdout_split(df, "id", 1.0)[1].count() == 0
    randomly = holdout_split(df, random=True)
    assert randomly[0].count() + randomly[1].count() == 2000
    with pytest.raises(ValueError):
        holdout_split(df)


def test_every_row_is_validated_once(spark):
    folded = assign_folds(spark.range(1000), "id", k=5)
    validated = [fold_split(folded, i, 5)[1] for i in range(5)]
    assert sum(v.count() for v in validated) == 1000
    for i in range(5):
        train, validation = fold_split(folded, i, 5)
        assert train.count() + validation.count() == 1000
    for bad in (-1, 5):
        with pytest.raises(ValueError):
            fold_split(folded, bad, 5)
    with pytest.raises(ValueError):
        assign_folds(folded, "id", k=1)


def test_bootstrap_weights_are_poisson(spark):
    df = spark.range(20000)
    weights = bootstrap_weight(df, "id", 3)
    mean, variance = weights.agg(F.avg("bootstrap_count"), F.var_pop("bootstrap_count")).first()
    assert abs(mean - 1) < 0.05 and abs(variance - 1) < 0.07
    assert bootstrap_rows(df, "id", 3).count() == weights.agg(F.sum("bootstrap_count")).first()[0]
    assert bootstrap_weight(df, "id", 3, drop_zero=True).count() == weights.filter("bootstrap_count > 0").count()
    assert 0.4 < bootstrap_rows(df, "id", 0, fraction=0.5).count() / 20000 < 0.6
    cutoffs = poisson_cutoffs(1.0)
    assert abs(cutoffs[0] - 0.36787944117144233 * BUCKETS) < 1000 and cutoffs == sorted(cutoffs) and BUCKETS - cutoffs[-1] <= 1
    with pytest.raises(ValueError):
        bootstrap_rows(df)


def test_metrics_equal_the_evaluator(spark):
    df = spark.range(1, 500).select(
        (F.col("id") * 3.0).alias("label"), (F.col("id") * 3.0 + F.sin("id") * 10).alias("prediction")
    )
    row = regression_metrics(df).first()
    for metric in ("rmse", "mae", "r2"):
        assert row[metric] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(df), rel=1e-12)
    some = df.filter("label % 2 = 0")
    blank = df.withColumn("prediction", F.when(F.col("label") % 2 == 0, F.col("prediction")))
    assert regression_metrics(blank).first()["r2"] == pytest.approx(regression_metrics(some).first()["r2"], rel=1e-12)
    zero = regression_metrics(df.withColumn("label", F.lit(0.0))).first()
    assert (zero.mape, zero.n_nonzero, zero.r2) == (0.0, 0, None)


def test_comparison_text_for_both_kinds_of_results(spark):
    folds = spark.createDataFrame(
        [("a", 0, 1000.0, 10.0, 0.5), ("a", 1, 3000.0, 30.0, 0.7), ("b", 0, 1.0, 1.0, 0.9), ("b", 1, 1.0, 1.0, 0.9)],
        "model string, fold int, rmse double, mae double, r2 double",
    )
    best, worst = model_comparison(cv_summary(folds)).collect()
    assert best.model == "b" and worst.rmse_text == "2,000 ± 1,000" and worst.r2_text == "0.6000 ± 0.1000"
    plain = model_comparison(folds.filter("fold = 0")).collect()
    assert plain[0].model == "b" and plain[1].rmse_text == "1,000"


@pytest.mark.parametrize("engine", ["forest", "weighted"])
def test_bagging_beats_nothing_saves_and_reloads(spark, rows, tmp_path, engine):
    bagging = BaggingRegressor(engine=engine, keyCol=KEY, numEstimators=4, maxDepth=5, maxBins=2)
    assert "numEstimators=4" in repr(bagging) and bagging.params_dict()["maxDepth"] == 5
    model = bagging.fit(rows)
    assert len(model.trees) == 4
    scored = model.transform(rows)
    assert set(scored.columns) == set(rows.columns) | {"prediction"}
    metrics = regression_metrics(scored).first()
    assert 0 < metrics.r2 <= 1
    importance = model.feature_importance().collect()
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    assert {r.feature for r in importance} == {"l_quantity", "p_brand_indexed"}
    assert {r.feature for r in model.feature_importance(["only one"]).collect()} == {"feature_0", "feature_1"}
    path = str(tmp_path / engine)
    model.write().overwrite().save(path)
    again = BaggingRegressionModel.load(path)
    assert again.feature_names == model.feature_names and again.getOrDefault("engine") == engine
    assert again.transform(rows).select("prediction").collect() == scored.select("prediction").collect()
    saved = str(tmp_path / f"{engine}-pipeline")
    PipelineModel([model]).write().overwrite().save(saved)
    assert PipelineModel.load(saved).transform(rows).count() == rows.count()


@pytest.mark.parametrize("engine", ["forest", "weighted"])
def test_bagging_does_not_depend_on_the_layout(spark, rows, engine):
    settings = dict(engine=engine, keyCol=KEY, numEstimators=3, maxDepth=4, layoutPartitions=3)
    results = []
    for partitions in (2, 7):
        fitted = BaggingRegressor(**settings).fit(rows.repartition(partitions, "l_quantity"))
        found = fitted.transform(rows).orderBy(*KEY).select("prediction")
        results.append([r[0] for r in found.collect()])
    assert results[0] == pytest.approx(results[1], rel=1e-9)


def test_trees_keep_the_nodes_of_rows_and_come_out_the_same(spark, rows, monkeypatch):
    fitted = lambda: {n: e.fit(rows) for n, e in baseline_models(cacheInput=False).items() if n != "Linear Regression"}
    keeping = fitted()
    for model in (keeping["Decision Tree"], keeping["Random Forest"], keeping["Bagging"].members[0]):
        assert model.getOrDefault("cacheNodeIds") and model.getOrDefault("checkpointInterval") == -1
    for place in (ensemble, training):
        monkeypatch.setattr(place, "KEPT_NODES", {})
    leading = fitted()
    for name in ("Decision Tree", "Random Forest"):
        assert keeping[name].toDebugString.split("\n")[1:] == leading[name].toDebugString.split("\n")[1:]
    assert not leading["Bagging"].members[0].getOrDefault("cacheNodeIds")
    for kept, led in zip(keeping["Bagging"].trees, leading["Bagging"].trees):
        assert kept.toDebugString.split("\n")[1:] == led.toDebugString.split("\n")[1:]


def test_weighted_and_repeated_rows_grow_the_same_tree(spark, rows):
    weighted = bootstrap_weight(rows, KEY, 0, drop_zero=True)
    repeated = bootstrap_rows(rows, KEY, 0)
    tree = DecisionTreeRegressor(maxDepth=4)
    a = tree.copy().setWeightCol("bootstrap_count").fit(weighted)
    b = tree.copy().fit(repeated)
    scored = [m.transform(rows).agg(F.sum("prediction")).first()[0] for m in (a, b)]
    assert scored[0] == pytest.approx(scored[1], rel=1e-6)


def test_bagging_settings_are_checked(spark, rows):
    with pytest.raises(ValueError):
        BaggingRegressor(engine="weighted").fit(rows)
    with pytest.raises(ValueError):
        BaggingRegressor(engine="boosted").fit(rows)
    with pytest.raises(ValueError):
        BaggingRegressor(layoutPartitions=4).fit(rows)
    with pytest.raises(ValueError):
        BaggingRegressor(numEstimators=0).fit(rows)
    with pytest.raises(RuntimeError):
        BaggingRegressionModel().transform(rows)
    with pytest.raises(RuntimeError):
        BaggingRegressionModel().feature_importance()


def test_min_instances_counts_sampled_rows(spark, rows):
    model = BaggingRegressor(
        engine="weighted", keyCol=KEY, numEstimators=2, maxDepth=4, minInstancesPerNode=800
    ).fit(rows)
    assert all(t.numNodes < 10 for t in model.trees)


def test_cross_validation_accepts_estimators_builders_and_pipelines(spark, rows):
    named = {
        "tree": DecisionTreeRegressor(maxDepth=3),
        "built": lambda: DecisionTreeRegressor(maxDepth=3),
        "pipeline": Pipeline(stages=[
            VectorAssembler(inputCols=["l_quantity"], outputCol="quantity"),
            LinearRegression(featuresCol="quantity"),
        ]),
        "bagging": BaggingRegressor(numEstimators=2, maxDepth=3, keyCol=KEY),
    }
    with cross_validate(rows, named, KEY, k=3) as result:
        metrics = {(r.model, r.fold): r for r in result.fold_metrics().collect()}
        assert len(metrics) == 12
        assert sum(r.n_rows for (m, _), r in metrics.items() if m == "tree") == rows.count()
        assert metrics["tree", 1].rmse == pytest.approx(metrics["built", 1].rmse)
        assert result.comparison().count() == 4
        assert result.predictions.groupBy("model", *KEY).count().filter("count > 1").count() == 0


def test_train_only_step_leaves_validation_rows_alone(spark, rows):
    outliers = OutlierFilter(inputCol="label", method="percentile", lower=0.2, upper=0.8)
    with cross_validate(rows, DecisionTreeRegressor(maxDepth=2), KEY, k=3, train_only=outliers) as result:
        assert result.predictions.count() == rows.count()
        limit = rows.agg(F.percentile("label", F.lit(0.85))).first()[0]
        assert result.predictions.agg(F.max("prediction")).first()[0] < limit


def test_more_folds_than_rows_is_an_error(spark, rows):
    with pytest.raises(ValueError):
        cross_validate(rows.limit(3), DecisionTreeRegressor(), KEY, k=10)


def test_models_fitted_together_score_in_one_scan(spark, rows):
    train, test = holdout_split(rows, KEY)
    fitted = fit_models(train, {"a": DecisionTreeRegressor(maxDepth=2), "b": LinearRegression()})
    stacked = stack_predictions(fitted, test, KEY)
    assert stacked.count() == 2 * test.count()
    direct = fitted["a"].transform(test).agg(F.sum("prediction")).first()[0]
    assert stacked.filter("model = 'a'").agg(F.sum("prediction")).first()[0] == pytest.approx(direct)


def test_entry_point(spark):
    import __spark_entry__ as driver

    found = driver.entry(spark).collect()
    assert {r.model for r in found} == {"Linear Regression", "Decision Tree", "Random Forest", "Bagging"}
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_failed_validation_leaves_no_cached_rows(spark):
    from tabreg.plans import cross_validate

    def broken():
        raise RuntimeError("no estimator")

    cached = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before = cached()
    rows = spark.range(300).select("id", (F.col("id") * 1.0).alias("label"))
    with pytest.raises(RuntimeError):
        cross_validate(rows, broken, "id", k=3)
    assert cached() == before


def test_bins_follow_the_widest_category(spark):
    from pyspark.ml.regression import DecisionTreeRegressor
    from tabreg.operators.features import feature_pipeline
    from tabreg.plans import fit_models

    rows = spark.range(900).select((F.col("id") % 300).cast("string").alias("c"), (F.col("id") * 1.0).alias("label"))
    coded = feature_pipeline([], ["c"]).fit(rows).transform(rows)
    assert fit_models(coded, {"tree": DecisionTreeRegressor(maxBins=32)})["tree"].getMaxBins() >= 300


def test_fixture_row_count(spark):
    assert txn(spark, "/root/testdata/sf0.01").count() == 15_300


def test_served_job_on_the_transactions_schema(spark, tmp_path):
    """From a CSV with all 46 columns to scored requests; two categories are always missing."""
    from tabreg.operators.score import score, validate_requests
    from tabreg.plans import load_report, load_served, train_for_serving
    from tabreg.sources import TRANSACTION_ROLES, TRANSACTIONS_SCHEMA, ingest_csv
    from workload.sources import _transactions_csv

    csv = _transactions_csv(spark, "/root/testdata/sf0.001")
    accepted, rejected = ingest_csv(spark, csv, TRANSACTIONS_SCHEMA)
    assert accepted.columns == TRANSACTIONS_SCHEMA.names and rejected.count() > 0
    path = str(tmp_path / "served")
    bagging = BaggingRegressor(numEstimators=3, maxDepth=4, keyCol=["transaction_id"])
    for _ in range(2):  # a second run replaces the first
        train_for_serving(accepted, TRANSACTION_ROLES, path, "transaction_id", bagging)
    model, dictionary = load_served(spark, path)
    assert {r.column_name for r in dictionary.collect()} == {"property_type_en", "property_usage_en", "area_name_en"}
    requests = accepted
    assert requests.filter("procedure_area is null or has_parking is null or area_name_en is null").count() > 0
    scored = score(requests, model)
    assert scored.filter("predicted_price < 0 or price_text not like 'AED %'").count() == 0
    undated = requests.filter("try_to_date(instance_date, 'dd-MM-yyyy') is null")
    assert scored.count() == requests.count()
    assert scored.filter("predicted_price is null").count() == undated.count()
    assert scored.filter("unscored_reason is not null").count() == undated.count()
    checked = validate_requests(requests, dictionary, ["area_name_en", "property_type_en"])
    assert checked.count() == requests.count()
    settings = load_report(spark, path, "settings").first()
    assert settings.numEstimators == 3 and len(settings.features) == 11


class Watch:
    """Sizes of the calls that run at the same time."""

    def __init__(self):
        self.now, self.seen, self.lock = [], [], threading.Lock()

    def __call__(self, size):
        with self.lock:
            self.now.append(size)
            self.seen.append(sorted(self.now))
        time.sleep(0.1)
        with self.lock:
            self.now.remove(size)
        return size


def test_calls_overlap_as_far_as_memory_goes(spark, monkeypatch):
    assert 0 < overlap.storage_memory(spark) < 1 << 40
    monkeypatch.setattr(overlap, "storage_memory", lambda spark: 100)
    sizes, watch = [20, 30, 30, 80, 0, 10, 50], Watch()
    assert overlap.overlapped(spark, watch, sizes, 8, sizes) == sizes
    # half of the memory is theirs; a call that needs more runs without other large ones
    assert all(sum(min(s, 50) for s in together) <= 50 for together in watch.seen)
    assert max(map(len, watch.seen)) > 1
    free = Watch()
    assert overlap.overlapped(spark, free, sizes, 8) == sizes
    assert max(map(len, free.seen)) == len(sizes)


def test_fits_wait_for_memory_and_give_the_same(spark, rows, monkeypatch):
    watch = Watch()

    class Watched(DecisionTreeRegressor):
        def _fit(self, dataset):
            watch(1)
            return super()._fit(dataset)

    models = {"one": Watched(maxDepth=3, maxBins=64, seed=1), "two": Watched(maxDepth=4, maxBins=64, seed=1)}

    def result():
        watch.seen.clear()
        found = cross_validate(rows, models, KEY, 3, parallelism=6).fold_metrics().orderBy("model", "fold").collect()
        scored = stack_predictions(fit_models(rows, models, 2), rows, KEY)
        return max(map(len, watch.seen)), found, regression_metrics(scored, ["model"]).orderBy("model").collect()

    together, *plenty = result()
    assert together > 1
    monkeypatch.setattr(overlap, "storage_memory", lambda spark: 1)
    together, *scarce = result()
    assert together == 1
    for a, b in zip(plenty, scarce, strict=True):
        assert [r["n_rows"] for r in a] == [r["n_rows"] for r in b]
        assert [r["rmse"] for r in a] == pytest.approx([r["rmse"] for r in b])


def test_kept_rows_grow_with_the_trees(rows):
    sizes = {n: training._kept_bytes(m, rows) for n, m in baseline_models(keyCol=KEY).items()}
    assert sizes["Decision Tree"] < sizes["Bagging"] < sizes["Random Forest"]
    weighted = BaggingRegressor(engine="weighted", keyCol=KEY)
    assert training._kept_bytes(weighted, rows) == 4 * training._kept_bytes(weighted, rows, one_fit_of_many=True)
    assert training._kept_bytes(lambda: DecisionTreeRegressor(), rows) == sizes["Decision Tree"]
