"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the local cores. Every
query starts from the raw tables, so cleaning and encoding are part of it. With
``--sequential`` the same comparison is also run as a plain loop (sample, fit,
three metric jobs, one fold after another), and reported under "sequential".
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "profile_missing",
    "profile_describe",
    "quantiles_exact",
    "dedup_subset",
    "clean_pipeline",
    "feature_table",
    "kfold_assign",
    "bootstrap_rows",
    "tree_predict",
    "bagging_predict",
    "bagging_forest_predict",
    "evaluate_holdout",
    "cv_metrics",
    "cv_compare_models",
    "residual_histogram",
    "score_batch",
    "score_input_validation",
    "compare_regressors",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabreg-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def sequential_comparison(spark: SparkSession, sf_dir: str) -> None:
    """Fold by fold, model by model, tree by tree, one job per metric."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
    from workload.features import feature_rows

    train, test = feature_rows(spark, sf_dir).randomSplit([0.8, 0.2], 42)
    rows = train.withColumn("fold", F.floor(F.rand(42) * 10)).cache()

    def bagged(train, test):
        for i in range(10):
            sample = train.sample(True, 1.0, 42 + i)
            tree = DecisionTreeRegressor(maxDepth=10, maxBins=256, predictionCol=f"p{i}", seed=42 + i)
            test = tree.fit(sample).transform(test)
        return test.withColumn("prediction", sum(F.col(f"p{i}") for i in range(10)) / 10)

    single = [
        lambda: LinearRegression(maxIter=100, regParam=0.1),
        lambda: DecisionTreeRegressor(maxDepth=10, maxBins=256),
        lambda: RandomForestRegressor(numTrees=20, maxDepth=10, maxBins=256),
    ]
    runs = [lambda train, test, new=new: new().fit(train).transform(test) for new in single] + [bagged]
    for run in runs:
        for fold in range(10):
            scored = run(rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold))
            for metric in ("rmse", "mae", "r2"):
                RegressionEvaluator(metricName=metric).evaluate(scored)
        final = run(rows, test)
        for metric in ("rmse", "mae", "r2"):
            RegressionEvaluator(metricName=metric).evaluate(final)
    rows.unpersist()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    from workload.catalog import QUERIES
    drain(QUERIES["profile_counts"](spark, sf_dir))  # JVM warm-up
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    for name in HEADLINE:
        timed(name, lambda: drain(QUERIES[name](spark, sf_dir)))
        spark.catalog.clearCache()
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": dict(times),
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "--sequential" in sys.argv:
        timed("sequential", lambda: sequential_comparison(spark, sf_dir))
        result["sequential"] = {"compare_regressors": times["sequential"]}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
