"""One result written to several tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


# Whether adaptive execution may merge and split the partitions of a result that is kept.
KEPT_ADAPTS = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session, put back at the end."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def computed_once(result: DataFrame) -> Iterator[DataFrame]:
    """Keep a result while it is written; what does not fit in memory goes to disk.

    Partitions that are lost with an executor are computed again. A result that is arranged is kept as it would be written:
    a large partition split, small ones together.
    """
    with setting(result.sparkSession, KEPT_ADAPTS, "true"):
        result = result.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield result
    finally:
        result.unpersist()


def side_by_side(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Run jobs that share the executors, so that the tail of one does not leave them idle."""
    target = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(target(job)) for job in jobs]:
            done.result()
