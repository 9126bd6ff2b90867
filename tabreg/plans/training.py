"""Training jobs: served features, cross-validation, fitting several models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from ..operators.clean import UNKNOWN, MissingValueImputerModel, present_mean, require
from ..operators.cells import cells, grow, is_cell_tree
from ..operators.ensemble import KEPT_NODES, BaggingRegressor
from ..operators.gram import fit_without_folds, has_closed_form
from ..operators.features import CALENDAR_COLUMNS, CalendarFeatures, LabelColumn, largest_arity, vector_width
from ..operators.metrics import cv_summary, model_comparison, regression_metrics
from ..operators.overlap import overlapped
from ..operators.resample import assign_folds, fold_split
from ..sources import stage
from .folds import Preparation, prepare_folds

ModelSpec = Estimator | Callable[[], Estimator]


def baseline_models(max_bins: int = 256, **bagging) -> dict[str, Estimator]:
    """The four compared regressors with their standard settings.

    Fits raise ``maxBins`` to the number of categories of the widest coded column, for all tree models. Trees keep each row's node from
    level to level (``KEPT_NODES``).
    """
    # Names and settings of the compared models.
    return {
        "Linear Regression": LinearRegression(maxIter=100, regParam=0.1),
        "Decision Tree": DecisionTreeRegressor(maxDepth=10, maxBins=max_bins, **KEPT_NODES),
        "Random Forest": RandomForestRegressor(numTrees=20, maxDepth=10, maxBins=max_bins, **KEPT_NODES),
        "Bagging": BaggingRegressor(numEstimators=10, maxDepth=10, maxBins=max_bins, seed=42, **bagging),
    }


def serving_fills(df: DataFrame, mean_cols: Sequence[str], zero_cols: Sequence[str], categorical: Sequence[str]) -> MissingValueImputerModel:
    """Fills by column name, as a stage that goes with the model: means, zeros, and 'Unknown' for categories."""
    fills: dict = {**dict.fromkeys(categorical, UNKNOWN), **dict.fromkeys(zero_cols, 0)}
    if mean_cols:
        means = df.agg(*[present_mean(c).alias(f"m{i}") for i, c in enumerate(mean_cols)]).first()
        fills.update({c: means[f"m{i}"] for i, c in enumerate(mean_cols) if means[f"m{i}"] is not None})
    return MissingValueImputerModel(fills)


def serving_features(
    df: DataFrame,
    target_col: str,
    date_col: str,
    mean_cols: Sequence[str],
    zero_cols: Sequence[str],
    categorical: Sequence[str],
) -> tuple[DataFrame, MissingValueImputerModel]:
    """(rows for the served model, its fills): calendar parts, fills, label, no missing target or date."""
    fills = serving_fills(df, mean_cols, zero_cols, categorical)
    return served_rows(df, target_col, date_col, fills), fills


def served_rows(df: DataFrame, target_col: str, date_col: str, fills: MissingValueImputerModel) -> DataFrame:
    """Rows for the served model by known fills."""
    dated = CalendarFeatures(dateCol=date_col).transform(df)
    kept = require(fills.transform(dated), [target_col, CALENDAR_COLUMNS[0]])
    return LabelColumn(targetCol=target_col).transform(kept)


class CrossValidation:
    """Out-of-fold predictions of all models, and the reports drawn from them. ``predictions`` reads the stored rows."""

    def __init__(self, predictions: DataFrame):
        self.predictions = predictions

    def fold_metrics(self) -> DataFrame:
        """One row per (model, fold), all from one aggregate."""
        return regression_metrics(self.predictions, by=("model", "fold"))

    @staticmethod
    def summarize(fold_metrics: DataFrame) -> DataFrame:
        return cv_summary(fold_metrics)

    def summary(self) -> DataFrame:
        return self.summarize(self.fold_metrics())

    def comparison(self) -> DataFrame:
        return model_comparison(self.summary())

    def __enter__(self) -> "CrossValidation":
        return self

    def __exit__(self, *_) -> None:
        pass


def cross_validate(
    df: DataFrame,
    models: dict[str, ModelSpec] | ModelSpec,
    key: str | Sequence[str] | None = None,
    k: int = 10,
    seed: int = 42,
    parallelism: int = 4,
    train_only: Estimator | None = None,
    label_col: str = "label",
    prediction_col: str = "prediction",
    random: bool = False,
    cache: bool = True,
    preparation: Preparation | None = None,
    fit_scope: str = "fold",
    keep: Sequence[str] = (),
) -> CrossValidation:
    """k-fold cross-validation of any number of models over the same folds.

    A model is any Estimator, or a function returning a fresh one; pipelines
    learn their indexers and fills from training rows only. ``train_only`` is
    a fitted step applied to training rows but not to validation rows (an
    outlier filter, say). Fits of different folds and models overlap, up to
    ``parallelism`` at a time and as far as the rows that they keep fit the executors'
    memory; they share one stored copy of the rows with a folder
    per fold, of which a fold's scans read what they need (``cache`` off: no copy,
    ``df`` is computed again). Linear models with a closed form are fitted for all folds by one pass (``operators.gram``), trees
    on codes alone by another (``operators.cells``).

    With a ``preparation``, ``df`` holds distinct raw rows, and price range, fills, sparse columns and codes are learned from each fold's
    training rows (``fit_scope`` 'fold') or, as leaks do, from all rows ('global'); see ``plans.folds``. ``keep`` names columns of
    the validation rows that the predictions carry along.
    """
    named = models if isinstance(models, dict) else {"model": models}
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    if preparation is not None:
        if not keys or random:
            raise ValueError("a preparation needs key columns and hashed folds")
        prepared = prepare_folds(df, preparation, keys, k, seed, fit_scope)
        folded, split = prepared.rows, prepared.split
    else:
        folded = assign_folds(df, key, k, seed, random)
        if cache:
            folded = stage(folded, "folds", "fold")

        def split(fold: int) -> tuple[DataFrame, DataFrame]:
            return fold_split(folded, fold, k)

    counts = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}  # one row per fold
    if len(counts) < k:
        raise ValueError(f"only {len(counts)} of {k} folds have rows")

    sample = split(0)[0]
    by_cells = {n: e for n, e in named.items() if train_only is None and not random and (cache or preparation is not None) and _from_cells(e, sample)}
    # without a preparation features do not depend on the fold: one pass gives the cells of all folds
    shared = {n: stage(_cells(e, folded, ["fold"]), "cells") for n, e in by_cells.items()} if preparation is None else {}

    def fit(task: tuple[str, int]):
        name, fold = task
        if name in by_cells:
            found = shared[name].filter(F.col("fold") != fold) if shared else stage(_cells(by_cells[name], split(fold)[0]), "cells")
            return _grown(_fresh(by_cells[name], found, True, one_fit_of_many=True), found)
        train, _ = split(fold)
        if train_only is not None:
            train = train_only.copy().fit(train).transform(train)
        return _fresh(named[name], train, cache, one_fit_of_many=True).fit(train)

    def fit_all(name: str) -> dict:
        return {(name, f): m for f, m in fit_without_folds(folded, named[name], list(range(k))).items()}

    one_pass = [n for n, m in named.items() if preparation is None and train_only is None and not random and has_closed_form(m)]
    tasks = [(name, fold) for name in named if name not in one_pass for fold in range(k)]
    calls = [(fit_all, n) for n in one_pass] + [(fit, t) for t in tasks]
    rows = sum(counts.values())
    sizes = [0] * len(one_pass) + [
        0 if name in by_cells else (rows - counts[fold]) * _kept_bytes(named[name], sample, one_fit_of_many=True) for name, fold in tasks
    ]
    done = overlapped(df.sparkSession, lambda call: call[0](call[1]), calls, parallelism, sizes)
    fitted = dict(zip(tasks, done[len(one_pass):]))
    for found in done[: len(one_pass)]:
        fitted.update(found)

    scored = []
    for fold in range(k):
        _, validation = split(fold)
        for group in _scored_together({name: fitted[name, fold] for name in named}):
            scored.append(
                stack_predictions(group, validation, ["fold", *keys, *keep], label_col, prediction_col)
            )
    return CrossValidation(reduce(DataFrame.unionByName, scored))


def fit_models(
    train: DataFrame, models: dict[str, ModelSpec], parallelism: int = 4, cache: bool = True
) -> dict:
    """Fit several models on one stored copy of the training rows (``cache`` off: on ``train`` itself): name -> fitted model."""
    rows = stage(train, "train") if cache else train
    sizes = None
    if cache:
        n = rows.count()
        sizes = [n * _kept_bytes(m, rows) for m in models.values()]
    fitted = overlapped(rows.sparkSession, lambda m: _fresh(m, rows, cache).fit(rows), list(models.values()), parallelism, sizes)
    return dict(zip(models, fitted))


def stack_predictions(
    fitted: dict,
    rows: DataFrame,
    keep: Sequence[str] = (),
    label_col: str = "label",
    prediction_col: str = "prediction",
) -> DataFrame:
    """(model, *keep, label, prediction) of all models over the same rows, in one scan.

    Each model adds its own column; the columns are then turned into rows.
    """
    wide, columns = rows, {}
    for i, (name, model) in enumerate(fitted.items()):
        columns[name] = f"__prediction_{i}"
        wide = model.transform(wide).withColumnRenamed(prediction_col, columns[name])
    pairs = [F.struct(F.lit(n).alias("model"), F.col(c).alias("prediction")) for n, c in columns.items()]
    return wide.select(
        *keep, F.col(label_col).alias("label"), F.explode(F.array(*pairs)).alias("p")
    ).select("p.model", *keep, "label", "p.prediction")


def _from_cells(spec: ModelSpec, rows: DataFrame) -> bool:
    """Whether the model comes out the same from cells of rows with equal features."""
    return is_cell_tree(rows, spec) or isinstance(spec, BaggingRegressor) and spec.grows_from_cells(rows)


def _cells(estimator: Estimator, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    if isinstance(estimator, BaggingRegressor):
        return estimator.cells(rows, by)
    return cells(rows, estimator.getOrDefault("featuresCol"), estimator.getOrDefault("labelCol"), [F.lit(1.0)], by)


def _grown(estimator: Estimator, found: DataFrame):
    return estimator.fit_cells(found) if isinstance(estimator, BaggingRegressor) else grow(found, estimator)


def _scored_together(fitted: dict) -> list[dict]:
    """Plain models share one scan; pipelines add columns of their own, so each gets its own."""
    plain = {n: m for n, m in fitted.items() if not isinstance(m, PipelineModel)}
    return [g for g in [plain, *[{n: m} for n, m in fitted.items() if n not in plain]] if g]


def _kept_bytes(spec: ModelSpec, rows: DataFrame, one_fit_of_many: bool = False) -> int:
    """About the bytes per row that a fit keeps in memory, as a tree learner does.

    The row and its binned features; for each tree the row's count in the bootstrap, and its node before and after a level.
    """
    estimator = spec if isinstance(spec, Estimator) else spec()

    def setting(name: str, default):
        return estimator.getOrDefault(name) if estimator.hasParam(name) else default

    trees, learners = setting("numTrees", setting("numEstimators", 1)), 1
    if setting("engine", "forest") == "weighted":
        trees, learners = 1, 1 if one_fit_of_many else min(trees, setting("parallelism", 1))
    features = setting("featuresCol", None)
    width = vector_width(rows, features) if features in rows.columns else 0
    return learners * (120 + 4 * width + 12 * trees)


def _fresh(spec: ModelSpec, train: DataFrame, rows_cached: bool, one_fit_of_many: bool = False) -> Estimator:
    """An estimator of its own for one fit, told what its surroundings already do."""
    estimator = spec.copy() if isinstance(spec, Estimator) else spec()
    settings = {}
    if rows_cached and estimator.hasParam("cacheInput"):
        settings[estimator.getParam("cacheInput")] = False
    if one_fit_of_many and estimator.hasParam("parallelism"):
        settings[estimator.getParam("parallelism")] = 1
    if estimator.hasParam("maxBins") and estimator.hasParam("featuresCol"):
        features, bins = estimator.getOrDefault("featuresCol"), estimator.getParam("maxBins")
        if features in train.columns:
            settings[bins] = max(estimator.getOrDefault(bins), largest_arity(train, features))
    return estimator.copy(settings)
