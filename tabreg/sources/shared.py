"""The folder all executors can reach, and tables staged in it."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder named by ``spark.checkpoint.dir``.

    Where the setting is absent (tests on one machine) a temporary folder is
    used; on a cluster that would be unreadable for other nodes, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    path = f"{root.rstrip('/')}/tabreg/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def stage(df: DataFrame, label: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the stored table, in folders by ``partition_by`` if given.

    Used where a result is read several times: later passes prune columns and
    push filters into the files, and a lost executor costs a re-read of a few
    files instead of a replay of the shuffles that made them. The written
    table goes away when the driver exits.
    """
    path = shared_path(df.sparkSession, label)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tabreg-")
