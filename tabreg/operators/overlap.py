"""Overlapping driver-side calls that each launch Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import partial
from multiprocessing.pool import ThreadPool
from threading import Condition

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Share of the executors' storage memory that overlapping calls may fill; the rest is left to shuffles and to what the estimate misses.
STORAGE_SHARE = 0.5


class Room:
    """Bytes that overlapping calls share; a call waits until the others leave enough. One that needs more than all of it runs by itself."""

    def __init__(self, total: int):
        self.total, self.used, self.change = total, 0, Condition()

    @contextmanager
    def taken(self, size: int):
        size = min(size, self.total)
        with self.change:
            self.change.wait_for(lambda: self.used + size <= self.total)
            self.used += size
        try:
            yield
        finally:
            with self.change:
                self.used -= size
                self.change.notify_all()


def overlapped(spark: SparkSession, action: Callable, items: Sequence, parallelism: int, sizes: Sequence[int] | None = None) -> list:
    """``[action(item) for item in items]``, up to ``parallelism`` calls at a time.

    Each call is wrapped by itself: the wrapper copies the caller's local
    properties, and calls that shared one copy would overwrite each other's
    execution ids. ``sizes`` are the bytes each call keeps in the executors' storage
    memory: fewer calls overlap where more would push each other's blocks to disk.
    """
    room = Room(max(1, int(storage_memory(spark) * STORAGE_SHARE)) if sizes else 0)

    def run(item, size: int):
        with room.taken(size):
            return action(item)

    calls = [inheritable_thread_target(spark)(partial(run, item, size)) for item, size in zip(items, sizes or [0] * len(items), strict=True)]
    with ThreadPool(max(1, min(parallelism, len(calls)))) as pool:
        return pool.map(lambda call: call(), calls, chunksize=1)


def storage_memory(spark: SparkSession) -> int:
    """Bytes of storage memory of all executors; of the driver where it is the only one."""
    context = spark.sparkContext._jsc.sc()
    status = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(context.getExecutorMemoryStatus())
    found = {at: both._1() for at, both in status.items()}
    if len(found) > 1:
        found.pop(context.env().blockManager().blockManagerId().hostPort(), None)
    return sum(found.values())
