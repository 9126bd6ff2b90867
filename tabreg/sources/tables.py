"""Stored tables and report files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Store a clean table, optionally by year so that scans prune whole folders.

    Rows are gathered by folder before writing, so a folder has few files;
    adaptive execution splits a folder that holds much of the table over
    several writers. Without ``rebalance`` nothing is shuffled and every task
    writes a file to every folder it meets.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header; outer blanks of values are kept."""
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, **keep_blanks).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Reports for other tools: category dictionary, model settings, test metrics."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
