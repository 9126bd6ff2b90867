"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.shared import stage

__all__ = ["connected_components", "parts", "per_batch", "read_table", "stage", "texts_of", "tokenizer_path"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null text is the empty text."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


#: Bytes of text that a Python worker turns into objects at once; a longer text is one part by itself.
PART_BYTES = 2 << 20


def parts(batch: pa.RecordBatch, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``limit`` bytes each, or one row."""
    if not batch.num_rows:
        return
    sizes = np.full(batch.num_rows, 16, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A ``mapInArrow`` function from one that turns a small batch into a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                if (out := work(part)) is not None and out.num_rows:
                    yield out

    return run


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node each linked node can reach.

    Alternates large-star and small-star (Kiveris et al. 2014): every round
    hangs neighbours onto the smallest node seen so far, until the edges are
    stars. Minima are grouped aggregates (combined before the shuffle) and are
    joined back, so that a hub's neighbours are never gathered; each round is
    stored in the shared folder. Only a count and a checksum reach the driver.
    Nodes are non-null longs; nodes without a link to another are not listed.
    """
    spark = edges.sparkSession
    current = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
    )
    seal = _seal(current)
    for _ in range(max_rounds):
        if seal[0] == 0:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        large = stage(large, "edges")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        )
        current = stage(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "edges")
        if (after := _seal(current)) == seal:
            break
        seal = after
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    ) if seal[0] else spark.createDataFrame([], "node long, root long")


def _seal(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()
    return row["n"], row["x"]
