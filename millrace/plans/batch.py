"""The layers as batch jobs, from the same functions as the streams."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import STATISTICS, Layout
from millrace.operators.windows import one_statistic, window_statistics
from millrace.sinks.fanout import computed_once
from millrace.operators.readings import explode_readings, valid_readings
from millrace.sources.backfill import FILES_AT_ONCE, all_bronze, pending_parts, record_files, texts_of
from millrace.streaming.bronze import store_texts
from millrace.streaming.gold import (
    gold_figures,
    gold_kept_by,
    partials_batch,
    partials_of,
    recompute_windows,
    with_window_bucket,
)
from millrace.streaming.silver import readings_of, records_of, silver_figures, store_batch

# Batch numbers below zero belong to batch jobs; streams count from zero.
REBUILD = -1
# Loads have numbers below this.
LOADS = 10**6


def silver_of(bronze: DataFrame, layout: Layout) -> DataFrame:
    return records_of(readings_of(bronze, layout), layout)


def gold_of(silver: DataFrame, layout: Layout) -> DataFrame:
    return window_statistics(silver, layout.window, layout.numeric)


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """A temporary view for each layer that exists, for use from SQL."""
    layers = {"silver": layout.silver}
    layers.update({f"metrics_{s}": layout.gold(s) for s in STATISTICS})
    found = [name for name, dataset in layers.items() if dataset.exists(spark)]
    for name in found:
        layers[name].read(spark).createOrReplaceTempView(name)
    if layout.bronze.exists(spark) or layout.backfill.exists(spark):
        all_bronze(spark, layout).createOrReplaceTempView("bronze")
        found = ["bronze", *found]
    return found


def rebuild(spark: SparkSession, layout: Layout) -> None:
    """Rebuild readings, silver, the metric tables and, if there are any, the partials from all of bronze.

    For use while no stream runs. The streams may go on from their checkpoints afterwards: a reading
    that arrives again does not change silver.
    """
    bronze = all_bronze(spark, layout)
    readings = readings_of(bronze, layout)
    layout.readings.overwrite(readings.withColumn("bid", F.lit(REBUILD)))
    stored = layout.readings.read(spark)
    layout.silver.overwrite(records_of(stored, layout))
    if layout.figures:
        layout.silver_figures.overwrite(silver_figures(layout.silver.read(spark)))
    stats = gold_of(layout.silver.read(spark), layout)
    with computed_once(with_window_bucket(stats, layout)) as stats:
        for statistic in STATISTICS:
            layout.gold(statistic).overwrite(one_statistic(stats, statistic, layout.numeric))
        if layout.figures:
            layout.gold_figures.overwrite(gold_figures(layout, stats))
    if layout.partials.exists(spark):
        readings = valid_readings(explode_readings(bronze, layout.order_by))
        layout.partials.overwrite(partials_of(layout, readings, REBUILD))


def part_number(load: int, part: int) -> int:
    """The batch number of a part of a load. Each has its own, below those of rebuilds."""
    return REBUILD - load - part * LOADS


def load_part(spark: SparkSession, layout: Layout, texts: DataFrame, load: int, part: int, kept_by: str, grow: bool) -> None:
    """Take the texts of one part up to the metric tables; the ledger last, which says that the part is done."""
    number = part_number(load, part)

    store_texts(layout, texts, "backfill", {"load": load, "part": part}, grow)
    # An earlier try may have had other files in this part.
    for dataset in (layout.readings, layout.partials):
        dataset.drop_batch(spark, number)
    loaded = layout.backfill.read(spark).where((F.col("load") == load) & (F.col("part") == part))
    touched = store_batch(layout, readings_of(loaded, layout), number)
    if kept_by == "partials":
        partials_batch(layout, valid_readings(explode_readings(loaded, layout.order_by)), number)
    else:
        recompute_windows(spark, layout, touched)
    record_files(layout, loaded, number)


def backfill(
    spark: SparkSession,
    layout: Layout,
    folder: str,
    load: int,
    by: str = "path",
    multi_line: bool = False,
    grow: bool = True,
    files_at_once: int = FILES_AT_ONCE,
) -> int:
    """Load the files below ``folder`` that bronze does not hold yet, up to the metric tables; the number of parts.

    ``load`` is a number from 1 that the caller gives to this load. It is done in parts of so many files, each of which is
    in the ledger when it is done. After a failure, run the same load again: it goes on with the part that was not. Gold that
    is kept by partials gets the load's own partials; gold that is kept in Spark's state cannot take a load, which is
    an error.
    """
    if not 1 <= load < LOADS:
        raise ValueError(f"loads are numbered from 1 to {LOADS - 1}")
    kept_by = gold_kept_by(spark, layout)
    if kept_by == "native":
        raise ValueError("windows kept in the state of a stream cannot take a backfill; use rebuild without that stream")
    done = layout.ledger.batches(spark)
    part = next(p for p in count() if part_number(load, p) not in done)
    for paths in pending_parts(spark, layout, folder, by, files_at_once):
        load_part(spark, layout, texts_of(spark, paths, multi_line), load, part, kept_by, grow)
        part += 1
    return part
