"""Bagged regression trees as a pyspark.ml Estimator and Model.

Two engines compute the same estimator (the mean of unrestricted trees, each
grown on its own bootstrap sample):

``forest``    All trees grow together, level by level, in one pass over the
              training rows per level: MLlib's forest learner with every
              feature tried at every split. The cost in passes does not grow
              with the number of trees. Its bootstrap follows the row order
              within partitions; with ``keyCol`` and ``layoutPartitions`` the
              rows are first laid out by key, which makes the result
              independent of how the input was partitioned.
``weighted``  One tree after another (a few at a time) on Poisson counts from
              a hash of the row key, used as row weights. Needs no layout and
              can be recomputed by any SQL engine, at one set of passes per
              tree; on vectors of codes alone one pass serves all trees
              (``operators.cells``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasParallelism,
    HasPredictionCol,
    HasSeed,
)
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..sources import stage
from .cells import cells, grow, grows_from_cells
from .features import largest_arity, vector_attributes
from .overlap import overlapped
from .resample import bootstrap_count, bootstrap_rows, bootstrap_weight

# Default ensemble settings.
DEFAULTS = dict(
    numEstimators=10,
    maxDepth=10,
    minInstancesPerNode=1,
    maxBins=256,
    seed=42,
    engine="forest",
    featuresCol="features",
    labelCol="label",
    predictionCol="prediction",
    parallelism=4,
    cacheInput=True,
    keyCol=[],
    layoutPartitions=0,
    maxMemoryInMB=512,
)
ENGINES = ("forest", "weighted")
#: A pass over the rows adds each to the node it has reached, instead of leading it down every tree from the root again. The trees come
#: out the same. A tree has 30 levels at most, too few for checkpoints of these to pay.
KEPT_NODES = dict(cacheNodeIds=True, checkpointInterval=-1)


class _BaggingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, HasParallelism):
    numEstimators = Param(Params._dummy(), "numEstimators", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "sampled rows a child must have", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "split candidates per feature; raised to the largest number of categories", TypeConverters.toInt)
    engine = Param(Params._dummy(), "engine", "'forest' or 'weighted'", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "columns that identify a row", TypeConverters.toListString)
    cacheInput = Param(Params._dummy(), "cacheInput", "persist the training columns while fitting", TypeConverters.toBoolean)
    layoutPartitions = Param(Params._dummy(), "layoutPartitions", "forest engine: lay rows out by key over this many partitions, 0 for as they are", TypeConverters.toInt)
    maxMemoryInMB = Param(Params._dummy(), "maxMemoryInMB", "memory for split statistics of one pass", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(**DEFAULTS)


class BaggingRegressor(Estimator, _BaggingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Bagged regression trees; see the module text for the two engines."""

    @keyword_only
    def __init__(
        self,
        *,
        numEstimators=10,
        maxDepth=10,
        minInstancesPerNode=1,
        maxBins=256,
        seed=42,
        engine="forest",
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        keyCol=None,
        parallelism=4,
        cacheInput=True,
        layoutPartitions=0,
        maxMemoryInMB=512,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def params_dict(self) -> dict:
        return {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}

    def __repr__(self) -> str:
        get = self.getOrDefault
        return (
            f"BaggingRegressor(engine={get('engine')}, "
            f"numEstimators={get('numEstimators')}, maxDepth={get('maxDepth')})"
        )

    def _fit(self, dataset: DataFrame) -> "BaggingRegressionModel":
        get = self.getOrDefault
        if get("engine") not in ENGINES:
            raise ValueError(f"engine must be one of {ENGINES}, not {get('engine')!r}")
        if get("numEstimators") < 1:
            raise ValueError("numEstimators must be at least 1")
        key = get("keyCol")
        if get("engine") == "weighted" and not key:
            raise ValueError("engine 'weighted' needs keyCol, the columns that identify a row")
        rows = dataset.select(*dict.fromkeys([*key, self.getFeaturesCol(), self.getLabelCol()]))
        names = [a.get("name", "") for a in vector_attributes(rows, self.getFeaturesCol())]
        if get("engine") == "forest":
            rows, fit = self._laid_out(rows), self._fit_forest
        elif self.grows_from_cells(rows):
            return self.fit_cells(stage(self.cells(rows), "cells"))
        else:
            fit = self._fit_weighted
        if get("cacheInput"):
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._copyValues(BaggingRegressionModel(fit(rows), names))
        finally:
            if get("cacheInput"):
                rows.unpersist()

    def _tree_settings(self, rows: DataFrame) -> dict:
        get = self.getOrDefault
        return dict(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            maxDepth=get("maxDepth"),
            minInstancesPerNode=get("minInstancesPerNode"),
            maxBins=max(get("maxBins"), largest_arity(rows, self.getFeaturesCol())),
            maxMemoryInMB=get("maxMemoryInMB"),
        )

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        key, partitions = self.getOrDefault("keyCol"), self.getOrDefault("layoutPartitions")
        if partitions and not key:
            raise ValueError("layoutPartitions needs keyCol")
        if partitions:
            rows = rows.repartition(partitions, *key)
        # A fixed order also makes a block lost mid-training come back the same.
        return rows.sortWithinPartitions(*key) if key else rows

    def _fit_forest(self, rows: DataFrame) -> list:
        get = self.getOrDefault
        forest = RandomForestRegressor(
            numTrees=get("numEstimators"),
            featureSubsetStrategy="all",
            subsamplingRate=1.0,
            bootstrap=True,
            seed=get("seed"),
            predictionCol=self.getPredictionCol(),
            **KEPT_NODES,
            **self._tree_settings(rows),
        )
        return [forest.fit(rows)]

    def grows_from_cells(self, rows: DataFrame) -> bool:
        get = self.getOrDefault
        return get("engine") == "weighted" and grows_from_cells(rows, self.getFeaturesCol(), get("minInstancesPerNode"))

    def cells(self, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """What ``fit_cells`` learns from: the cells of all draws, per value of ``by``."""
        get = self.getOrDefault
        weights = [bootstrap_count(get("keyCol"), i, get("seed")) for i in range(get("numEstimators"))]
        return cells(rows, self.getFeaturesCol(), self.getLabelCol(), weights, by)

    def fit_cells(self, found: DataFrame) -> "BaggingRegressionModel":
        """The model that ``fit`` gives for the rows of these cells, a stored table."""
        names = [a.get("name", "") for a in vector_attributes(found, self.getFeaturesCol())]
        return self._copyValues(BaggingRegressionModel(self._fit_cells(found), names))

    def _fit_cells(self, found: DataFrame) -> list:
        settings = self._tree_settings(found)

        def grow_one(i: int):
            return grow(found, DecisionTreeRegressor(predictionCol=_member_column(i), seed=self.getOrDefault("seed") + i, **settings), i)

        return overlapped(found.sparkSession, grow_one, range(self.getOrDefault("numEstimators")), self.getOrDefault("parallelism"))

    def _fit_weighted(self, rows: DataFrame) -> list:
        get = self.getOrDefault
        settings = self._tree_settings(rows)
        by_rows = get("minInstancesPerNode") > 1  # a node counts rows, not weights

        def grow(i: int):
            tree = DecisionTreeRegressor(
                predictionCol=_member_column(i), seed=get("seed") + i, **settings
            )
            if by_rows:
                return tree.fit(bootstrap_rows(rows, get("keyCol"), i, get("seed")))
            sample = bootstrap_weight(
                rows, get("keyCol"), i, get("seed"), column="__weight", drop_zero=True
            )
            return tree.setWeightCol("__weight").fit(sample)

        return overlapped(rows.sparkSession, grow, range(get("numEstimators")), get("parallelism"))


class BaggingRegressionModel(Model, _BaggingParams, MLWritable, MLReadable):
    """Fitted ensemble. ``members`` are single trees, or one forest holding all trees."""

    def __init__(self, members: list | None = None, feature_names: list[str] | None = None):
        super().__init__()
        self.members = members or []
        self.feature_names = feature_names or []

    @property
    def trees(self) -> list:
        return [t for m in self.members for t in (m.trees if hasattr(m, "trees") else [m])]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self._require_fitted()
        features, output = self.getFeaturesCol(), self.getPredictionCol()
        if len(self.members) == 1:
            member = self.members[0]
            return member.setFeaturesCol(features).setPredictionCol(output).transform(dataset)
        # Chained projections: the optimizer merges them into one.
        scored = dataset
        for i, member in enumerate(self.members):
            scored = member.setFeaturesCol(features).setPredictionCol(_member_column(i)).transform(scored)
        columns = [_member_column(i) for i in range(len(self.members))]
        total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
        return scored.withColumn(output, total / len(columns)).drop(*columns)

    def feature_importance(self, feature_names: list[str] | None = None) -> DataFrame:
        """(feature, importance, importance_rank): mean over trees, largest first.

        Names come from the training vector, or ``feature_i`` when the given
        ones do not match. One row per feature, computed from the model alone.
        """
        self._require_fitted()
        vectors = [t.featureImportances.toArray() for t in self.trees]
        means = sum(vectors) / len(vectors)
        names = self.feature_names if feature_names is None else feature_names
        if len(names) != len(means):
            names = [f"feature_{i}" for i in range(len(means))]
        ranked = sorted(zip(names, means.tolist()), key=lambda pair: (-pair[1], pair[0]))
        schema = StructType([
            StructField("feature", StringType()),
            StructField("importance", DoubleType()),
            StructField("importance_rank", IntegerType()),
        ])
        rows = [(name, value, i + 1) for i, (name, value) in enumerate(ranked)]
        return _session().createDataFrame(rows, schema)

    def _require_fitted(self) -> None:
        if not self.members:
            raise RuntimeError("the ensemble has no fitted trees")

    def copy(self, extra=None):
        copied = super().copy(extra)
        copied.members, copied.feature_names = list(self.members), list(self.feature_names)
        return copied

    def write(self) -> MLWriter:
        return _BaggingWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BaggingReader()


class _BaggingWriter(MLWriter):
    """Metadata with the settings, and one folder per member, on any file system Spark writes to."""

    def __init__(self, model: BaggingRegressionModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        self.model._require_fitted()
        is_forest = isinstance(self.model.members[0], RandomForestRegressionModel)
        extra = {
            "memberCount": len(self.model.members),
            "memberKind": "forest" if is_forest else "tree",
            "featureNames": self.model.feature_names,
        }
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)
        for i, member in enumerate(self.model.members):
            member.save(f"{path}/members/{i}")


class _BaggingReader(MLReader):
    def load(self, path: str) -> BaggingRegressionModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        kind = RandomForestRegressionModel if metadata["memberKind"] == "forest" else DecisionTreeRegressionModel
        members = [kind.load(f"{path}/members/{i}") for i in range(metadata["memberCount"])]
        model = BaggingRegressionModel(members, metadata["featureNames"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _member_column(i: int) -> str:
    return f"__tree_{i}"


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
