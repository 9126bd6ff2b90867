"""Tables that grow by files: deduplication against what is stored, and a profile that reads new files only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions import is_numeric, missing
from ..sources import shared_path, stage

FINGERPRINT = "__fingerprint"


class DistinctStore:
    """Distinct whole rows, stored in buckets by their fingerprint, so that arriving rows find their equals without moving the stored ones.

    The store is a folder of bucketed Parquet files under a table name of the session's catalog. Rows are told apart by
    all their values (NULL equals NULL); a fingerprint only says where to look.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    @classmethod
    def create(cls, rows: DataFrame, name: str, buckets: int = 200, path: str | None = None) -> "DistinctStore":
        """A new store with the distinct rows of ``rows``, in ``path`` or else in the shared folder.

        ``buckets`` bounds what one task holds later and should not be below the session's shuffle partitions, or Spark moves both sides.
        """
        path = path or shared_path(rows.sparkSession, "distinct")
        writer = _marked(rows).dropDuplicates().write.bucketBy(buckets, FINGERPRINT).sortBy(FINGERPRINT)
        writer.option("path", path).format("parquet").saveAsTable(name)
        return cls(rows.sparkSession, name)

    @classmethod
    def attach(cls, spark: SparkSession, name: str, path: str, schema: str, buckets: int) -> "DistinctStore":
        """The store another session left in ``path``; ``schema`` names its columns without the fingerprint."""
        spark.sql(
            f"CREATE TABLE `{name}` ({schema}, `{FINGERPRINT}` BIGINT) USING parquet OPTIONS (path '{path}') "
            f"CLUSTERED BY (`{FINGERPRINT}`) SORTED BY (`{FINGERPRINT}`) INTO {buckets} BUCKETS"
        )
        return cls(spark, name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop(FINGERPRINT)

    def new_rows(self, arriving: DataFrame) -> DataFrame:
        """The distinct rows of ``arriving`` that the store does not hold. Only ``arriving`` is shuffled.

        Equal arriving rows become one, stored row before they meet the store, so a row that holds a third of a delivery is one row there.
        """
        columns = arriving.columns
        fresh = stage(_marked(arriving).dropDuplicates(), "arriving").alias("new")
        kept = self.spark.table(self.name).alias("old")
        mine, theirs = [F.struct(*[F.col(f"{side}.`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]) for side in ("new", "old")]
        # the fingerprint alone deals the rows, as it does the buckets: whole rows are compared by a condition that is no join key
        found = (F.col(f"new.{FINGERPRINT}") == F.col(f"old.{FINGERPRINT}")) & F.array_contains(F.array(mine), theirs)
        return fresh.join(kept.hint("merge"), found, "left_anti").select(*[F.col(f"`{c}`") for c in columns])

    def add(self, arriving: DataFrame) -> None:
        """Store the new rows of ``arriving`` beside the old ones."""
        columns = [c for c in self.spark.table(self.name).columns if c != FINGERPRINT]
        rows = _marked(self.new_rows(arriving.select(*[F.col(f"`{c}`") for c in columns])))
        details = self.spark.sql(f"DESCRIBE FORMATTED `{self.name}`").filter("col_name = 'Num Buckets'").first()
        rows.write.bucketBy(int(details["data_type"]), FINGERPRINT).sortBy(FINGERPRINT).format("parquet").mode("append").saveAsTable(self.name)


def _marked(df: DataFrame) -> DataFrame:
    return df.withColumn(FINGERPRINT, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


STATE = (
    "file string, column_name string, position int, dtype string, rows long, missing_count long, value_count long, mean double, products double, "
    "min_value double, max_value double, min_text string, max_text string, quantiles binary, distinct binary"
)
KLL_K, HLL_K = 400, 14


class FileProfile:
    """A stored table of mergeable states per (file, column): counts, moments, extremes, and sketches of quantiles and distinct values.

    A refresh reads the files that have no state yet; reports merge states and read no file. Files are taken as written once.
    """

    def __init__(self, spark: SparkSession, path: str, files: str | Sequence[str]):
        self.spark, self.path = spark, path
        self.files = [files] if isinstance(files, str) else list(files)

    def states(self) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(self.path)

    def refresh(self) -> DataFrame:
        """Adds the states of new files; returns their names."""
        from pyspark.errors import AnalysisException

        source = self.spark.read.parquet(*self.files)
        try:
            known = self.states().select("file").distinct().alias("k")
            known.schema  # an absent folder shows here
            names = source.select(F.col("_metadata.file_path").alias("file")).distinct()
            new = [r["file"] for r in names.join(known, "file", "left_anti").collect()]  # names of new files
        except AnalysisException:
            new = None
        if new == []:
            return self.spark.createDataFrame([], "file string")
        wanted = source if new is None else self.spark.read.parquet(*new)
        file_states(wanted).write.mode("append").parquet(self.path)
        return wanted.select(F.col("_metadata.file_path").alias("file")).distinct()

    def _merged(self) -> DataFrame:
        states = self.states()
        n = F.sum("value_count").cast("double")
        mean = F.try_divide(F.sum(F.col("mean") * F.col("value_count")), n)
        total = states.groupBy("column_name").agg(
            F.min("position").alias("position"), F.first("dtype").alias("dtype"), F.sum("rows").alias("rows"), F.sum("missing_count").alias("missing_count"),
            F.sum("value_count").alias("value_count"), mean.alias("mean"),
            F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct", F.lit(True)).alias("distinct"),
        )
        # products around the common mean: those around each file's mean, and the means' distances from it
        means = total.select(F.col("column_name").alias("c"), F.col("mean").alias("common"))
        apart = states.join(means, F.col("column_name") == F.col("c")).groupBy("column_name").agg(
            F.sum("products").alias("within"), F.sum(F.col("value_count") * F.pow(F.col("mean") - F.col("common"), F.lit(2.0))).alias("between")
        )
        return total.join(apart, "column_name")

    def missing_report(self) -> DataFrame:
        """As ``profile.missing_report`` over all files seen."""
        share = F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("rows")), 2)
        return self._merged().select("column_name", "missing_count", share.alias("missing_pct"), "dtype")

    def describe(self) -> DataFrame:
        """As ``profile.describe`` over all files seen, with the approximate median and number of distinct values."""
        deviation = F.when(F.col("value_count") > 1, F.sqrt((F.col("within") + F.col("between")) / (F.col("value_count") - 1)))
        return self._merged().select(
            "column_name", "value_count", "mean", deviation.alias("stddev"), "min_value", "max_value", "min_text", "max_text",
            F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("approx_median"),
            F.hll_sketch_estimate("distinct").alias("approx_distinct"),
        )


def file_states(df: DataFrame) -> DataFrame:
    """One state per (file, column) of a file-based frame, from one aggregate by file."""
    fields = [f for f in df.schema.fields if is_numeric(f.dataType) or isinstance(f.dataType, StringType)]
    aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
    states = []
    for i, f in enumerate(fields):
        value, numeric = F.col(f"`{f.name}`"), is_numeric(f.dataType)
        number = value.cast("double")
        aggregates += [
            F.count_if(missing(f)).alias(f"gaps{i}"), F.count(value).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
            F.hll_sketch_agg(value.cast("string"), HLL_K).alias(f"seen{i}"),
        ]
        if numeric:
            aggregates += [
                F.avg(number).alias(f"mean{i}"), (F.var_pop(number) * F.count(value)).alias(f"m2{i}"),
                F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(KLL_K)).alias(f"kll{i}"),
            ]
        no = {k: F.lit(None).cast(k) for k in ("double", "string", "binary")}
        states.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i).alias("position"), F.lit(f.dataType.typeName()).alias("dtype"), F.col("rows"),
            F.col(f"gaps{i}").alias("missing_count"), F.col(f"n{i}").alias("value_count"),
            (F.col(f"mean{i}") if numeric else no["double"]).alias("mean"), (F.col(f"m2{i}") if numeric else no["double"]).alias("products"),
            (F.col(f"lo{i}").cast("double") if numeric else no["double"]).alias("min_value"), (F.col(f"hi{i}").cast("double") if numeric else no["double"]).alias("max_value"),
            (no["string"] if numeric else F.col(f"lo{i}")).alias("min_text"), (no["string"] if numeric else F.col(f"hi{i}")).alias("max_text"),
            (F.col(f"kll{i}") if numeric else no["binary"]).alias("quantiles"), F.col(f"seen{i}").alias("distinct"),
        ))
    by_file = df.select("*", F.col("_metadata.file_path").alias("__file")).groupBy(F.col("__file").alias("file")).agg(*aggregates)
    return by_file.select("file", F.inline(F.array(*states)))
