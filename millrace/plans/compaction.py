"""Compaction of what streams keep by batch number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import Layout
from millrace.operators.windows import combine_partials
from millrace.sources.tables import BATCH, FOLDED, Dataset, delete_folder, superseded
from millrace.streaming.gold import with_window_bucket


def compact_dataset(spark: SparkSession, dataset: Dataset, fold: Callable[[DataFrame], DataFrame], least: int) -> int:
    """Fold the stream's batches of each partition that has ``least`` of them into one; the number of partitions folded.

    The batch stored last is left alone, since it may be run again; those before it are committed. A
    partition's folded rows appear with one rename, and from then on readers pass over the batches they stand for,
    whether these are deleted yet or not. So a run that stops anywhere is made good by the next.
    """
    if not dataset.is_path:
        raise ValueError("only folders are compacted here")
    partitions = dataset.batch_folders(spark)
    last = max((n for batches in partitions.values() for n in batches), default=-1)
    old, paths, folded = [], [], 0
    for batches in partitions.values():
        gone = superseded(list(batches))
        old += [batches[n] for n in gone]
        live = [n for n in batches if n not in gone and (0 <= n < last or n <= FOLDED)]
        if sum(n >= 0 for n in live) >= least:
            paths += [batches[n] for n in live]
            folded += 1
    if paths:
        rows = spark.read.schema(dataset.schema).option("basePath", dataset.location).parquet(*paths)
        dataset.overwrite_partitions(fold(rows).withColumn(BATCH, F.lit(FOLDED - (last - 1))))
    for path in {*old, *paths}:
        delete_folder(spark, path)
    return folded


def compact(spark: SparkSession, layout: Layout, least: int = 8) -> dict[str, int]:
    """Compact readings, window partials and the ledger of files of a layout in folders, between two runs of its streams.

    Batches of backfills and rebuilds keep their own numbers, so that they can be run again. Partials of one window
    become one; readings are only brought together.
    """

    def one_per_window(partials: DataFrame) -> DataFrame:
        return with_window_bucket(combine_partials(partials, layout.numeric), layout)

    return {
        "readings": compact_dataset(spark, layout.readings, lambda rows: rows, least),
        "window_partials": compact_dataset(spark, layout.partials, one_per_window, least),
        "bronze_files": compact_dataset(spark, layout.ledger, lambda rows: rows, least),
    }
