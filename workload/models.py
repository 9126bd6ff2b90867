"""Model fitting, cross-validation, comparison, importance and diagnostics.

The trees that have an SQL twin use two coded columns and may grow as deep as
the categories require, so each (area_name, property_type) cell ends in a leaf
of its own and the prediction is the (weighted) mean label of the cell.
"""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabreg.operators.diagnose import (
    bins_2d,
    histogram,
    residual_summary,
    sample_pairs,
    top_features,
    with_residual,
)
from tabreg.operators.ensemble import BaggingRegressionModel, BaggingRegressor
from tabreg.operators.features import CalendarFeatures, category_indexer, coded, feature_assembler
from tabreg.operators.metrics import cv_summary, evaluate, model_comparison, regression_metrics
from tabreg.operators.resample import holdout_split
from tabreg.plans import Preparation, baseline_models, cross_validate, fit_models, prepare_folds, sales_rows, stack_predictions
from tabreg.sources import shared_path, stage

from .features import _SLOTS, clean_rows, feature_rows
from .fixture import AREA, DATE, KIND, PARKING, TARGET, bucket_sql, txn, txn_nan, with_ctes
from .registry import query, rounded
from .resampling import K, SEED, fold_sql, in_train_sql, poisson_sql

CELL = ["area_name", "property_type"]
TREES, DEPTH = 10, 30
LINEAR, TREE, BAGGING = "Linear Regression", "Decision Tree", "Bagging"


def cell_rows(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Clean rows with ``features`` (coded cell), ``area_vector`` (one number) and ``label``."""
    rows = clean_rows(spark, sf_dir)
    rows = category_indexer(CELL).fit(rows).transform(rows)
    rows = feature_assembler([], coded(CELL)).transform(rows)
    rows = VectorAssembler(inputCols=[AREA], outputCol="area_vector").transform(rows)
    return rows.select("txn_id", *keep, "features", "area_vector", F.col(TARGET).alias("label"))


def linear() -> LinearRegression:
    return LinearRegression(featuresCol="area_vector", regParam=0.0)


def cell_tree() -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=DEPTH)


def cell_bagging() -> BaggingRegressor:
    return BaggingRegressor(
        engine="weighted", keyCol=["txn_id"], numEstimators=TREES, maxDepth=DEPTH, seed=SEED
    )


# --- SQL twins -------------------------------------------------------------

_ROWS = f"""rows_ AS (SELECT txn_id, area_name, property_type, procedure_area, actual_worth AS label,
  {in_train_sql()} AS in_train, {fold_sql()} AS fold FROM clean)"""
_DRAWN = f"""drawn AS (SELECT r.*, i, {poisson_sql(f"concat('{SEED}:', i)")} AS w
  FROM rows_ r, range({TREES}) AS draws(i))"""


def _holdout(name: str) -> str:
    """Predictions on the test rows of a model fitted to the train rows."""
    return {
        LINEAR: """SELECT t.*, m.slope * t.procedure_area + m.intercept AS prediction FROM rows_ t,
  (SELECT regr_slope(label, procedure_area) AS slope, regr_intercept(label, procedure_area) AS intercept
   FROM rows_ WHERE in_train) m WHERE NOT t.in_train""",
        TREE: """SELECT t.*, m.prediction FROM rows_ t JOIN (SELECT area_name, property_type, avg(label) AS prediction
  FROM rows_ WHERE in_train GROUP BY ALL) m USING (area_name, property_type) WHERE NOT t.in_train""",
        BAGGING: """SELECT t.*, m.prediction FROM rows_ t JOIN (SELECT area_name, property_type, avg(mean_i) AS prediction FROM
   (SELECT area_name, property_type, i, sum(w * label) / sum(w) AS mean_i FROM drawn WHERE in_train GROUP BY ALL)
   GROUP BY ALL) m USING (area_name, property_type) WHERE NOT t.in_train""",
    }[name]


def _out_of_fold(name: str) -> str:
    """Predictions on each fold of a model fitted to the other folds."""
    return {
        LINEAR: f"""SELECT t.*, m.slope * t.procedure_area + m.intercept AS prediction FROM rows_ t JOIN
  (SELECT f.fold, regr_slope(label, procedure_area) AS slope, regr_intercept(label, procedure_area) AS intercept
   FROM rows_ r JOIN folds f ON r.fold <> f.fold GROUP BY f.fold) m ON t.fold = m.fold""",
        TREE: """SELECT t.*, m.prediction FROM rows_ t JOIN (SELECT f.fold, area_name, property_type, avg(label) AS prediction
   FROM rows_ r JOIN folds f ON r.fold <> f.fold GROUP BY ALL) m
  ON t.fold = m.fold AND t.area_name = m.area_name AND t.property_type = m.property_type""",
        BAGGING: """SELECT t.*, m.prediction FROM rows_ t JOIN (SELECT fold, area_name, property_type, avg(mean_i) AS prediction FROM
   (SELECT f.fold, area_name, property_type, i, sum(w * label) / sum(w) AS mean_i
    FROM drawn r JOIN folds f ON r.fold <> f.fold GROUP BY ALL) GROUP BY ALL) m
  ON t.fold = m.fold AND t.area_name = m.area_name AND t.property_type = m.property_type""",
    }[name]


_FOLDS = f"folds AS (SELECT CAST(n AS INT) AS fold FROM range({K}) AS r(n))"


def _stacked(parts: dict[str, str]) -> str:
    return "preds AS (" + " UNION ALL ".join(
        f"SELECT '{name}' AS model, txn_id, fold, label, prediction FROM ({sql})" for name, sql in parts.items()
    ) + ")"


_HOLDOUT_PREDS = ",\n".join([_ROWS, _DRAWN, _stacked({n: _holdout(n) for n in (LINEAR, TREE, BAGGING)})])
_CV_TREE = ",\n".join([_ROWS, _FOLDS, _stacked({TREE: _out_of_fold(TREE)})])
_CV_TWO = ",\n".join([_ROWS, _FOLDS, _stacked({n: _out_of_fold(n) for n in (LINEAR, TREE)})])
_CV_ALL = ",\n".join([_ROWS, _FOLDS, _DRAWN, _stacked({n: _out_of_fold(n) for n in (LINEAR, TREE, BAGGING)})])

_METRICS = """count(*) AS n_rows, sqrt(avg((label - prediction) ** 2)) AS rmse, avg(abs(label - prediction)) AS mae,
  1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)) AS r2,
  avg(abs((label - prediction) / label) * 100) FILTER (WHERE label <> 0) AS mape,
  count(*) FILTER (WHERE label <> 0) AS n_nonzero"""
_ROUNDED_METRICS = "n_rows, round(rmse, 2) AS rmse, round(mae, 2) AS mae, round(r2, 6) AS r2, round(mape, 4) AS mape, n_nonzero"
_FOLD_METRICS = f"fm AS (SELECT model, fold, {_METRICS} FROM preds GROUP BY model, fold)"
_CV_SUMMARY = """summary AS (SELECT model, count(*) AS folds, avg(rmse) AS rmse_mean, stddev_pop(rmse) AS rmse_std,
  avg(mae) AS mae_mean, stddev_pop(mae) AS mae_std, avg(r2) AS r2_mean, stddev_pop(r2) AS r2_std FROM fm GROUP BY model)"""


def _shown_metrics(df: DataFrame) -> DataFrame:
    df = rounded(df, 2, "rmse", "mae")
    return rounded(rounded(df, 6, "r2"), 4, "mape")


def _money_sql(value: str) -> str:
    return f"format('{{:,}}', CAST(round_even({value}, 0) AS BIGINT))"


# --- single models ---------------------------------------------------------


@query(with_ctes("clean", select="""SELECT round(regr_slope(actual_worth, procedure_area), 4) AS slope,
  round(regr_intercept(actual_worth, procedure_area), 2) AS intercept, count(*) AS n_rows FROM clean"""))
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(cell_rows(spark, sf_dir))
    model = linear().fit(rows)
    return rows.agg(
        F.round(F.lit(model.coefficients[0]), 4).alias("slope"),
        F.round(F.lit(model.intercept), 2).alias("intercept"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _ridge_sql(columns: list[str], source: str, penalty: float) -> str:
    """CTEs up to ``ridge`` (w, m, s, my, sy): weights of scaled columns by Gauss-Jordan steps on their correlations, means and deviations."""
    size = len(columns)
    rows = ", ".join(
        "[" + ", ".join(f"1 + {penalty} / stddev_pop(label)" if a == b else f"corr({a}, {b})" for b in columns) + f", corr({a}, label)]"
        for a in columns
    )
    listed = ["[" + ", ".join(f"{f}({c})" for c in columns) + "]" for f in ("avg", "stddev_pop")]
    return f"""moments AS (SELECT [{rows}] AS a, {listed[0]} AS m, {listed[1]} AS s, avg(label) AS my, stddev_pop(label) AS sy FROM {source}),
steps AS (SELECT 1 AS k, a FROM moments UNION ALL
  SELECT k + 1, list_transform(range(1, {size + 1}), lambda i: CASE WHEN i = k THEN list_transform(a[k], lambda v: v / a[k][k])
    ELSE list_transform(range(1, {size + 2}), lambda j: a[i][j] - a[i][k] / a[k][k] * a[k][j]) END) FROM steps WHERE k <= {size}),
ridge AS (SELECT list_transform(steps.a, lambda row: row[{size + 1}]) AS w, m, s, my, sy FROM steps, moments WHERE k = {size + 1})"""


def _ridge_prediction(columns: list[str]) -> str:
    return "my + sy * (" + " + ".join(f"w[{i}] / s[{i}] * ({c} - m[{i}])" for i, c in enumerate(columns, 1)) + ")"


@query(with_ctes("coded", extra=f"seen AS (SELECT * FROM coded WHERE {in_train_sql()}),\n" + _ridge_sql(_SLOTS, "seen", 0.1),
    select=f"""SELECT txn_id, label, round({_ridge_prediction(_SLOTS)}, 1) AS prediction FROM coded, ridge WHERE NOT ({in_train_sql()})""").replace("WITH ", "WITH RECURSIVE ", 1))
def linear_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard settings on the full feature vector."""
    train, test = holdout_split(stage(feature_rows(spark, sf_dir)), "txn_id")
    scored = evaluate(baseline_models()["Linear Regression"].fit(train), test)[0]
    return rounded(scored, 1, "prediction").select("txn_id", "label", "prediction")


@query(with_ctes("clean", extra=_ROWS, select=f"SELECT txn_id, label, round(prediction, 1) AS prediction FROM ({_holdout(TREE)})"))
def tree_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = holdout_split(stage(cell_rows(spark, sf_dir)), "txn_id")
    return rounded(cell_tree().fit(train).transform(test), 1, "prediction").select("txn_id", "label", "prediction")


@query()
def forest_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = holdout_split(stage(feature_rows(spark, sf_dir)), "txn_id")
    return evaluate(baseline_models()["Random Forest"].fit(train), test)[0].select("txn_id", "label", "prediction")


@query(with_ctes("clean", extra=_ROWS, select=f"SELECT txn_id, label, round(prediction, 1) AS prediction FROM ({_holdout(TREE)})"))
def forest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest whose trees see all rows and features: the mean of each cell."""
    train, test = holdout_split(stage(cell_rows(spark, sf_dir)), "txn_id")
    forest = RandomForestRegressor(numTrees=3, maxDepth=DEPTH, bootstrap=False, featureSubsetStrategy="all")
    return rounded(forest.fit(train).transform(test), 1, "prediction").select("txn_id", "label", "prediction")


@query(with_ctes("clean", extra=",\n".join([_ROWS, _DRAWN]),
    select=f"SELECT txn_id, label, round(prediction, 2) AS prediction FROM ({_holdout(BAGGING)})"))
def bagging_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = holdout_split(stage(cell_rows(spark, sf_dir)), "txn_id")
    return rounded(cell_bagging().fit(train).transform(test), 2, "prediction").select("txn_id", "label", "prediction")


@query()
def bagging_forest_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard settings on the full feature vector, all trees grown together."""
    train, test = holdout_split(stage(feature_rows(spark, sf_dir)), "txn_id")
    model = BaggingRegressor(keyCol=["txn_id"], layoutPartitions=8).fit(train)
    return model.transform(test).select("txn_id", "label", "prediction")


def _bagging_on_all(spark: SparkSession, sf_dir: str) -> BaggingRegressionModel:
    return BaggingRegressor(keyCol=["txn_id"], layoutPartitions=8).fit(stage(feature_rows(spark, sf_dir)))


@query()
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bagging_on_all(spark, sf_dir).feature_importance()


@query(with_ctes("dated", extra=f"""flags AS (SELECT txn_id, actual_worth AS label, unnest([has_parking, CAST(procedure_area > 100 AS INT), CAST(trans_month > 6 AS INT)]) AS v,
  unnest(['has_parking', 'large', 'late']) AS feature FROM dated WHERE trans_year IS NOT NULL),
drawn AS (SELECT f.*, i, {poisson_sql(f"concat('{SEED}:', i)")} AS w FROM flags f, range({TREES}) AS draws(i)),
sides AS (SELECT i, feature, v, sum(w) AS n, sum(w * label) AS s FROM drawn GROUP BY ALL),
gains AS (SELECT i, feature, sum(s * s / n) AS gain FROM sides GROUP BY ALL),
best AS (SELECT i, arg_max(feature, gain) AS feature FROM gains GROUP BY i)""",
    select=f"""SELECT feature, round(count(best.i) * 1.0 / {TREES}, 6) AS importance, CAST(row_number() OVER (ORDER BY count(best.i) DESC, feature) AS INT) AS importance_rank
  FROM (SELECT unnest(['has_parking', 'large', 'late']) AS feature) LEFT JOIN best USING (feature) GROUP BY feature"""))
def importance_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance from trees of one split on two-valued features: the share of draws in which the feature explains most."""
    rows = CalendarFeatures(dateCol=DATE).transform(clean_rows(spark, sf_dir)).filter("trans_year is not null")
    flags = [F.col(PARKING).cast("double").alias("has_parking"), (F.col(AREA) > 100).cast("double").alias("large"), (F.col("trans_month") > 6).cast("double").alias("late")]
    rows = stage(feature_assembler(["has_parking", "large", "late"], []).transform(rows.select("txn_id", F.col(TARGET).alias("label"), *flags)))
    stumps = BaggingRegressor(engine="weighted", keyCol=["txn_id"], numEstimators=TREES, maxDepth=1, seed=SEED)
    return rounded(top_features(stumps.fit(rows).feature_importance(["has_parking", "large", "late"]), 3), 6, "importance")


@query()
def importance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_features(_bagging_on_all(spark, sf_dir).feature_importance(), 5)


@query(with_ctes("clean", extra=",\n".join([_ROWS, _DRAWN]),
    select=f"SELECT txn_id, round(prediction, 2) AS before, round(prediction, 2) AS after FROM ({_holdout(BAGGING)})"))
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted indexers and ensemble saved, loaded, and compared on the test rows."""
    train, test = holdout_split(stage(clean_rows(spark, sf_dir)), "txn_id")
    indexers = category_indexer(CELL).fit(clean_rows(spark, sf_dir))
    assembler = feature_assembler([], coded(CELL))
    prepared = assembler.transform(indexers.transform(train.withColumn("label", F.col(TARGET))))
    model = PipelineModel([indexers, assembler, cell_bagging().fit(prepared)])
    path = shared_path(spark, "model")
    model.write().overwrite().save(path)
    before = model.transform(test).select("txn_id", F.round("prediction", 2).alias("before"), *CELL)
    after = PipelineModel.load(path).transform(before)
    return after.select("txn_id", "before", F.round("prediction", 2).alias("after"))


# --- metrics and comparison ------------------------------------------------


@query(with_ctes("txn", extra="preds AS (SELECT property_type, coalesce(actual_worth, 0) AS label, 9000 * coalesce(procedure_area, 0) AS prediction FROM txn)",
    select=f"SELECT property_type, {_ROUNDED_METRICS} FROM (SELECT property_type, {_METRICS} FROM preds GROUP BY property_type)"))
def metrics_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = txn(spark, sf_dir).select(
        "property_type",
        F.coalesce(TARGET, F.lit(0.0)).alias("label"),
        (F.coalesce(AREA, F.lit(0.0)) * 9000).alias("prediction"),
    )
    return _shown_metrics(regression_metrics(scored, ["property_type"]))


@query(with_ctes("txn", extra="preds AS (SELECT property_type, actual_worth AS label, 9000 * procedure_area AS prediction FROM txn WHERE txn_id % 3 > 0 AND actual_worth IS NOT NULL AND procedure_area IS NOT NULL)",
    select=f"SELECT property_type, {_ROUNDED_METRICS} FROM (SELECT property_type, {_METRICS} FROM preds GROUP BY property_type)"))
def metrics_null_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows have no prediction; no metric may look at them."""
    prediction = F.when(F.col("txn_id") % 3 > 0, F.col(AREA) * 9000)
    scored = txn(spark, sf_dir).select("property_type", F.col(TARGET).alias("label"), prediction.alias("prediction"))
    return _shown_metrics(regression_metrics(scored, ["property_type"]))


def holdout_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = holdout_split(stage(cell_rows(spark, sf_dir)), "txn_id")
    fitted = fit_models(train, {LINEAR: linear(), TREE: cell_tree(), BAGGING: cell_bagging()})
    return stack_predictions(fitted, test, ["txn_id"])


@query(with_ctes("clean", extra=_HOLDOUT_PREDS, select=f"SELECT model, {_ROUNDED_METRICS} FROM (SELECT model, {_METRICS} FROM preds GROUP BY model)"))
def evaluate_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_metrics(regression_metrics(holdout_predictions(spark, sf_dir), ["model"]))


@query(with_ctes("clean", extra=_CV_TREE, select="SELECT txn_id, fold, label, round(prediction, 1) AS prediction FROM preds"))
def cv_oof_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(cell_rows(spark, sf_dir))
    with cross_validate(rows, cell_tree(), "txn_id", K, SEED) as validated:
        predictions = stage(validated.predictions, "out-of-fold")
    return rounded(predictions, 1, "prediction").select("txn_id", "fold", "label", "prediction")


@query(with_ctes("clean", extra=f"""r AS (SELECT txn_id, {fold_sql()} AS fold, procedure_area AS x, CAST(has_parking AS DOUBLE) AS z, actual_worth AS y FROM clean),
{_FOLDS},
m AS (SELECT f.fold, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(z) AS sz, stddev_pop(y) AS sy,
  corr(x, z) AS xz, corr(x, y) AS xy, corr(z, y) AS zy, 1 + 0.1 / stddev_pop(y) AS d FROM r JOIN folds f ON r.fold <> f.fold GROUP BY f.fold),
w AS (SELECT *, (d * xy - xz * zy) / (d * d - xz * xz) * sy / sx AS bx, (d * zy - xz * xy) / (d * d - xz * xz) * sy / sz AS bz FROM m)""",
    select="SELECT txn_id, r.fold, y AS label, round(my + bx * (x - mx) + bz * (z - mz), 1) AS prediction FROM r JOIN w ON r.fold = w.fold"))
def cv_linear_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge regression on two features, all folds from one pass."""
    rows = VectorAssembler(inputCols=[AREA, PARKING], outputCol="features").transform(clean_rows(spark, sf_dir))
    rows = rows.select("txn_id", "features", F.col(TARGET).alias("label"))
    validated = cross_validate(rows, LinearRegression(regParam=0.1), "txn_id", K, SEED)
    return rounded(validated.predictions, 1, "prediction").select("txn_id", "fold", "label", "prediction")


# What each fold may learn from: the other folds' rows inside their own price range.
_LEARNED = f"""{_FOLDS},
asked AS (SELECT *, {fold_sql()} AS fold, coalesce(area_name, 'Unknown') AS area_text, actual_worth AS label FROM sales),
ranges AS (SELECT left_out, greatest(CAST(0 AS DOUBLE), q1 - 3.0 * (q3 - q1)) AS lo, q3 + 3.0 * (q3 - q1) AS hi FROM (
  SELECT f.fold AS left_out, quantile_disc(label, 0.25) AS q1, quantile_disc(label, 0.75) AS q3
  FROM asked a JOIN folds f ON a.fold <> f.fold GROUP BY f.fold)),
learned AS (SELECT left_out, lo, hi, a.* FROM asked a JOIN ranges ON a.fold <> left_out AND label BETWEEN lo AND hi),
state AS (SELECT left_out, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS n_rows, avg(procedure_area) AS area_fill,
  avg(has_parking) AS parking_fill FROM learned GROUP BY left_out)"""


@query(with_ctes("sales", extra=_LEARNED, select="""SELECT left_out AS fold, round(lo, 4) AS lower, round(hi, 4) AS upper, n_rows,
  round(area_fill, 6) AS area_fill, round(parking_fill, 6) AS parking_fill FROM state"""))
def cv_fold_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price range, rows and fills that each fold learns from the others, merged from one state per fold."""
    rows = sales_rows(txn(spark, sf_dir), KIND, staged=False)
    facts = prepare_folds(rows, Preparation(TARGET, (AREA, PARKING)), "txn_id", K, SEED).facts()
    return facts.select(
        "fold", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n_rows",
        F.round(F.col("fills")[AREA], 6).alias("area_fill"), F.round(F.col("fills")[PARKING], 6).alias("parking_fill"),
    )


@query(with_ctes("sales", extra=_LEARNED + """,
codes AS (SELECT left_out, area_text, CAST(row_number() OVER (PARTITION BY left_out ORDER BY count(*) DESC, area_text) - 1 AS DOUBLE) AS code
  FROM learned GROUP BY left_out, area_text),
sizes AS (SELECT left_out, CAST(count(*) AS DOUBLE) AS n FROM codes GROUP BY left_out),
line AS (SELECT left_out, regr_slope(label, coalesce(procedure_area, area_fill)) AS slope, regr_intercept(label, coalesce(procedure_area, area_fill)) AS base
  FROM learned JOIN state USING (left_out) GROUP BY left_out),
cells AS (SELECT left_out, area_text, property_type, avg(label) AS mean FROM learned GROUP BY ALL),
priced AS (SELECT * FROM asked WHERE label IS NOT NULL)""", select="""SELECT 'Linear Regression' AS model, txn_id, fold, label,
  round(base + slope * coalesce(procedure_area, area_fill), 1) AS prediction, NULL AS area_code
  FROM priced JOIN state s ON fold = s.left_out JOIN line ON fold = line.left_out
UNION ALL SELECT 'Decision Tree', txn_id, fold, label, round(mean, 1), coalesce(code, n) FROM priced JOIN sizes s ON fold = s.left_out
  LEFT JOIN codes c ON fold = c.left_out AND priced.area_text = c.area_text
  JOIN cells ON fold = cells.left_out AND priced.area_text = cells.area_text AND priced.property_type = cells.property_type"""))
def cv_pipeline_leak_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price range, fills and codes learned inside each fold; a line on the filled area, a tree on the cells."""
    rows = stage(sales_rows(txn(spark, sf_dir), KIND, staged=False), "sales")
    by_area = Preparation(TARGET, numeric=(AREA,))
    line = cross_validate(rows, {LINEAR: LinearRegression()}, "txn_id", K, SEED, preparation=by_area, fit_scope="fold")
    by_cell = Preparation(TARGET, categorical=tuple(CELL))
    code = coded(CELL)[0]
    tree = cross_validate(rows, {TREE: cell_tree()}, "txn_id", K, SEED, parallelism=8, preparation=by_cell, fit_scope="fold", keep=[code])
    shown = line.predictions.withColumn("area_code", F.lit(None).cast("double")).unionByName(tree.predictions.withColumnRenamed(code, "area_code"))
    return rounded(shown, 1, "prediction").select("model", "txn_id", "fold", "label", "prediction", "area_code")


def _fold_metrics(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Stored metrics per (model, fold)."""
    models: dict[str, Estimator] = {LINEAR: linear(), TREE: cell_tree(), BAGGING: cell_bagging()}
    rows = stage(cell_rows(spark, sf_dir))
    chosen = {n: models[n] for n in names}
    with cross_validate(rows, chosen, "txn_id", K, SEED, parallelism=8) as validated:
        return stage(validated.fold_metrics(), "fold-metrics")


@query(with_ctes("clean", extra=_CV_TWO + ",\n" + _FOLD_METRICS, select=f"SELECT model, fold, {_ROUNDED_METRICS} FROM fm"))
def cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_metrics(_fold_metrics(spark, sf_dir, LINEAR, TREE))


@query(with_ctes("clean", extra=_CV_TWO + ",\n" + _FOLD_METRICS + ",\n" + _CV_SUMMARY, select="""SELECT model, folds,
  round(rmse_mean, 2) AS rmse_mean, round(rmse_std, 2) AS rmse_std, round(mae_mean, 2) AS mae_mean, round(mae_std, 2) AS mae_std,
  round(r2_mean, 6) AS r2_mean, round(r2_std, 6) AS r2_std FROM summary"""), name="cv_summary")
def cv_summary_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = cv_summary(_fold_metrics(spark, sf_dir, LINEAR, TREE))
    summary = rounded(summary, 2, "rmse_mean", "rmse_std", "mae_mean", "mae_std")
    return rounded(summary, 6, "r2_mean", "r2_std")


@query(with_ctes("clean", extra=_CV_ALL + ",\n" + _FOLD_METRICS, select=f"SELECT model, fold, {_ROUNDED_METRICS} FROM fm"))
def cv_compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_metrics(_fold_metrics(spark, sf_dir, LINEAR, TREE, BAGGING))


_COMPARED = f"""SELECT model,
  concat({_money_sql('rmse_mean')}, ' ± ', {_money_sql('rmse_std')}) AS rmse_text,
  concat({_money_sql('mae_mean')}, ' ± ', {_money_sql('mae_std')}) AS mae_text,
  concat(format('{{:.4f}}', r2_mean), ' ± ', format('{{:.4f}}', r2_std)) AS r2_text,
  round(rmse_mean, 2) AS rmse, round(mae_mean, 2) AS mae, round(r2_mean, 6) AS r2 FROM summary ORDER BY r2_mean DESC"""


@query(with_ctes("clean", extra=_CV_TWO + ",\n" + _FOLD_METRICS + ",\n" + _CV_SUMMARY, select=_COMPARED), name="model_comparison")
def model_comparison_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = model_comparison(cv_summary(_fold_metrics(spark, sf_dir, LINEAR, TREE)))
    return rounded(rounded(compared, 2, "rmse", "mae"), 6, "r2")


@query(with_ctes("clean", extra=_HOLDOUT_PREDS, select=f"""SELECT model, {_money_sql('rmse')} AS rmse_text, {_money_sql('mae')} AS mae_text,
  format('{{:.4f}}', r2) AS r2_text, round(rmse, 2) AS rmse, round(mae, 2) AS mae, round(r2, 6) AS r2
  FROM (SELECT model, {_METRICS} FROM preds GROUP BY model) ORDER BY 7 DESC"""))
def model_comparison_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = model_comparison(regression_metrics(holdout_predictions(spark, sf_dir), ["model"]))
    return rounded(rounded(compared, 2, "rmse", "mae"), 6, "r2")


# --- diagnostics -----------------------------------------------------------


def tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with the tree's prediction, stored because charts read them more than once."""
    train, test = holdout_split(stage(cell_rows(spark, sf_dir)), "txn_id")
    scored = cell_tree().fit(train).transform(test)
    return stage(rounded(scored, 2, "prediction").select("txn_id", "label", "prediction"), "predictions")


_SCORED = _ROWS + f",\nscored AS (SELECT txn_id, label, round(prediction, 2) AS prediction FROM ({_holdout(TREE)}))"


def bin_sql(value: str, low: str, high: str, bins: int) -> str:
    return f"least(CAST(floor(({value} - {low}) * CAST({bins} AS DOUBLE) / ({high} - {low})) AS INT), {bins - 1})"


def histogram_sql(source: str, value: str, bins: int = 50) -> str:
    return f"""v AS (SELECT {value} AS v FROM {source} WHERE {value} IS NOT NULL),
lim AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
counted AS (SELECT {bin_sql('v', 'lo', 'hi', bins)} AS bin, count(*) AS n FROM v, lim GROUP BY 1),
hist AS (SELECT CAST(i AS INT) AS bin, round(lo + i * ((hi - lo) / {bins}), 6) AS lower_edge,
  round(lo + (i + 1) * ((hi - lo) / {bins}), 6) AS upper_edge, coalesce(n, 0) AS row_count
  FROM range({bins}) AS r(i) CROSS JOIN lim LEFT JOIN counted ON counted.bin = i)"""


@query(with_ctes("clean", extra=_SCORED, select="SELECT txn_id, label, prediction, round(prediction - label, 6) AS residual FROM scored"))
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(with_residual(tree_predictions(spark, sf_dir)), 6, "residual")


@query(with_ctes("clean", extra=_SCORED + ",\nr AS (SELECT prediction - label AS r FROM scored)", select="""SELECT count(*) AS n_rows,
  round(avg(r), 4) AS mean, round(stddev_samp(r), 4) AS stddev, round(min(r), 6) AS min_value, round(max(r), 6) AS max_value,
  """ + ", ".join(f"round(quantile_disc(r, {p}), 6) AS p{round(p * 100):02d}" for p in (0.05, 0.25, 0.5, 0.75, 0.95)) + " FROM r"),
  name="residual_summary")
def residual_summary_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = rounded(residual_summary(tree_predictions(spark, sf_dir)), 4, "mean", "stddev")
    return rounded(summary, 6, "min_value", "max_value", "p05", "p25", "p50", "p75", "p95")


@query(with_ctes("clean", extra=_SCORED + ",\n" + histogram_sql("scored", "prediction - label"), select="SELECT * FROM hist"))
def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = histogram(tree_predictions(spark, sf_dir), F.col("prediction") - F.col("label"))
    return rounded(bars, 6, "lower_edge", "upper_edge")


@query(with_ctes("clean", extra=_SCORED + """,
lim AS (SELECT min(label) AS lx, max(label) AS hx, min(prediction) AS ly, max(prediction) AS hy FROM scored)""",
    select=f"""SELECT {bin_sql('label', 'lx', 'hx', 20)} AS x_bin, {bin_sql('prediction', 'ly', 'hy', 20)} AS y_bin,
  count(*) AS row_count FROM scored, lim GROUP BY 1, 2"""))
def pred_actual_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bins_2d(tree_predictions(spark, sf_dir))


@query(with_ctes("clean", extra=_SCORED, select=f"""SELECT txn_id, label, prediction FROM scored
  WHERE {bucket_sql('txn_id', repr(f'sample:{SEED}'))}
  < least(CAST(1 AS DOUBLE), CAST(500 AS DOUBLE) / (SELECT count(*) FROM scored)) * CAST(1152921504606846976 AS DOUBLE)"""))
def pred_actual_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pairs(tree_predictions(spark, sf_dir), "txn_id", size=500, seed=SEED)


@query(with_ctes("clean", extra=histogram_sql("clean", "actual_worth"), select="SELECT * FROM hist"))
def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(histogram(clean_rows(spark, sf_dir), F.col(TARGET)), 6, "lower_edge", "upper_edge")


@query(with_ctes("clean", extra=histogram_sql("clean", "ln(actual_worth + 1)"), select="SELECT * FROM hist"))
def price_log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(histogram(clean_rows(spark, sf_dir), F.log1p(TARGET)), 6, "lower_edge", "upper_edge")


@query(with_ctes("txn", extra=histogram_sql("(SELECT procedure_area AS p FROM txn WHERE txn_id % 23 <> 0)", "p"), select="SELECT * FROM hist"))
def histogram_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN is in no bin and moves no edge."""
    return rounded(histogram(txn_nan(spark, sf_dir), F.col("nan_area")), 6, "lower_edge", "upper_edge")
