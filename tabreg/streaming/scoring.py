"""Scoring requests as they arrive.

Scoring keeps no state, so the batch operator runs unchanged on a stream; the
file sink and its checkpoint give each request exactly one stored score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.score import score


def read_requests(
    spark: SparkSession, path: str, schema: StructType, max_files_per_batch: int | None = None
) -> DataFrame:
    """Stream of Parquet request files as they land in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def write_scores(
    requests: DataFrame,
    model,
    columns: list[str],
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = False,
    **score_options,
) -> StreamingQuery:
    """Score a stream and append ``columns`` of the result to a Parquet folder.

    ``available_now`` drains what is there and stops; otherwise the query runs on.
    """
    writer = (
        score(requests, model, **score_options)
        .select(*columns)
        .writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
