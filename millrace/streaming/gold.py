"""Silver to the four metric tables, in three ways.

``start_gold`` recomputes the windows of the touched partitions: exact for every order of arrival;
``start_silver_and_gold`` does so in the query that builds silver.
``start_gold_partials`` keeps mergeable partials: does not read silver again, exact when no reading
comes twice. ``start_gold_native`` keeps the windows in Spark's state: lowest latency, drops rows
behind the watermark.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.catalog import STATISTICS, Layout
from millrace.functions.times import bucket_of_instant, in_shards, instant, interval_seconds
from millrace.operators.figures import figures
from millrace.operators.readings import explode_readings, valid_readings
from millrace.operators.wide import pivot_readings
from millrace.operators.windows import (
    merge_partials,
    one_statistic,
    reading_window_statistics,
    window_partials,
    window_statistics,
)
from millrace.sinks.fanout import computed_once, setting, side_by_side
from millrace.sinks.upsert import checked_rows, write_merged
from millrace.sources.tables import Partitions, path_exists
from millrace.streaming.bronze import DRAIN
from millrace.streaming.silver import readings_of, store_batch

WINDOW_KEY = ["device_id", "window_start"]
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
ADAPTIVE = "spark.sql.adaptive.enabled"


def with_window_bucket(stats: DataFrame, layout: Layout) -> DataFrame:
    bucket = bucket_of_instant(F.col("window_start"), layout.grain)
    return stats.withColumn("window_bucket", in_shards(bucket, "device_id", layout.shards))


def replace_windows(layout: Layout, stats: DataFrame) -> None:
    """Write whole window partitions, one table per statistic, from one computation.

    The metric tables are cut and ordered alike: the windows are arranged once, before they are kept, and no table shuffles
    or sorts them again.
    """
    with computed_once(layout.gold(STATISTICS[0]).arranged(with_window_bucket(stats, layout))) as stats:

        def write(statistic: str) -> None:
            layout.gold(statistic).overwrite_partitions(one_statistic(stats, statistic, layout.numeric), arrange=False)

        # The first write fills the cache on its own: executors that start on it together would
        # compute the same partition side by side.
        first, *others = STATISTICS
        write(first)
        jobs = [partial(write, s) for s in others]
        if layout.figures:
            jobs.append(lambda: layout.gold_figures.overwrite_partitions(gold_figures(layout, stats)))
        side_by_side(stats.sparkSession, jobs)


def gold_figures(layout: Layout, windows: DataFrame) -> DataFrame:
    """Figures of the windows in any of the metric tables; a window counts by its place in time."""
    number = F.floor(F.unix_millis("window_start") / (1_000 * interval_seconds(layout.window)))
    return figures(windows, "window_bucket", "window_start", {"device": F.col("device_id"), "window": number})


def upsert_windows(layout: Layout, stats: DataFrame) -> None:
    """Insert or replace single windows, one table per statistic, from one computation."""
    with computed_once(with_window_bucket(stats, layout)) as stats:
        touched = Partitions.of(stats, "window_bucket")
        if touched.values == []:
            return

        # The metric tables have the same windows: they are checked, and kept, once for all.
        rows = checked_rows(stats, WINDOW_KEY)

        def write(statistic: str) -> None:
            write_merged(layout.gold(statistic), one_statistic(stats, statistic, layout.numeric), WINDOW_KEY, touched, rows)

        side_by_side(stats.sparkSession, [partial(write, s) for s in STATISTICS])
        if layout.figures:
            rebuilt = layout.gold(STATISTICS[0]).read_partitions(stats.sparkSession, touched)
            layout.gold_figures.overwrite_partitions(gold_figures(layout, rebuilt))


def recompute_windows(spark: SparkSession, layout: Layout, touched: Partitions) -> None:
    """Recompute every window of some silver partitions.

    A partition holds whole windows, so its windows need no other partition. Late rows correct
    their window, nothing is added twice, and a replay gives the same tables.
    """
    if touched.values == []:
        return
    silver = layout.silver.read_partitions(spark, touched)
    replace_windows(layout, window_statistics(silver, layout.window, layout.numeric))


def recompute_batch(layout: Layout, changes: DataFrame, batch_id: int) -> None:
    recompute_windows(changes.sparkSession, layout, Partitions.of(changes, "event_bucket"))


def start_gold(
    spark: SparkSession, layout: Layout, trigger: dict = DRAIN, **limits: str | int
) -> StreamingQuery:
    # Announcements are deleted once they are done with, so that the folder stays short.
    clean = "delete" if layout.changes.is_path else None
    changes = layout.changes.read_stream(spark, cleanSource=clean, **limits)
    return _start(layout, changes, recompute_batch, "gold", trigger)


def start_silver_and_gold(
    spark: SparkSession, layout: Layout, trigger: dict = DRAIN, **limits: str | int
) -> StreamingQuery:
    """Both layers in one query: no second trigger and no announcements to follow.

    It goes on from the checkpoint of ``start_silver``; run one or the other.
    """

    def both(layout: Layout, readings: DataFrame, batch_id: int) -> None:
        recompute_windows(readings.sparkSession, layout, store_batch(layout, readings, batch_id, announce=False))

    readings = readings_of(layout.bronze.read_stream(spark, **limits), layout)
    return _start(layout, readings, both, "silver", trigger)


def partials_of(layout: Layout, readings: DataFrame, batch_id: int) -> DataFrame:
    wide = pivot_readings(readings, layout.catalog, ("device_id", "timestampUtc"))
    wide = wide.withColumn("event_time", instant("timestampUtc"))
    partials = with_window_bucket(window_partials(wide, layout.window, layout.numeric), layout)
    return partials.withColumn("bid", F.lit(batch_id).cast("bigint"))


def gold_kept_by(spark: SparkSession, layout: Layout) -> str:
    """How gold is kept, told by the checkpoints: ``recompute``, ``partials`` or ``native``."""
    for name in ("native", "partials"):
        if path_exists(spark, layout.checkpoint(f"gold_{name}")):
            return name
    return "recompute"


def partials_batch(layout: Layout, readings: DataFrame, batch_id: int) -> None:
    """Add one batch of readings to the partials and refresh the windows it touches.

    The partials of a batch replace partition (bucket, batch), so a replay does not count twice.
    """
    spark = readings.sparkSession
    with computed_once(partials_of(layout, readings, batch_id)) as partials:
        touched = Partitions.of(partials, "window_bucket")
        if touched.values == []:
            return
        layout.partials.overwrite_partitions(partials)
        stored = layout.partials.read_partitions(spark, touched)
        replace_windows(layout, merge_partials(stored, layout.numeric))


def start_gold_partials(
    spark: SparkSession, layout: Layout, trigger: dict = DRAIN, **limits: str | int
) -> StreamingQuery:
    bronze = layout.bronze.read_stream(spark, **limits)
    readings = valid_readings(explode_readings(bronze, layout.order_by))
    return _start(layout, readings, partials_batch, "gold_partials", trigger)


def native_batch(layout: Layout, stats: DataFrame, batch_id: int) -> None:
    """Upsert the changed windows.

    A stream with state runs without adaptive execution, and so would the writes of its batches: their rows would not be
    arranged, and every task would write a small file into every partition. The state is planned without it as before.
    """
    with setting(stats.sparkSession, ADAPTIVE, "true"):
        upsert_windows(layout, stats)


def start_gold_native(
    spark: SparkSession,
    layout: Layout,
    trigger: dict = DRAIN,
    distinct: bool = True,
    state_partitions: int | None = None,
    **limits: str | int,
) -> StreamingQuery:
    """Windows in Spark's state, changed windows upserted after each batch.

    Reads bronze. Rows behind the watermark are dropped, and so is, with ``distinct``, a reading
    that comes again within it; of different values, any one stays. A null value never displaces a
    reading. Where devices never repeat themselves, without ``distinct`` one shuffle of all readings
    and its state are saved. The state has ``state_partitions`` (else those of the session) for the
    life of the checkpoint; choose it at the first start.
    """
    bronze = layout.bronze.read_stream(spark, **limits)
    readings = valid_readings(explode_readings(bronze)).withColumn("event_time", instant("timestampUtc"))
    readings = readings.withWatermark("event_time", layout.watermark)
    if distinct:
        readings = readings.withColumn("missing", F.col("value").isNull())
        readings = readings.dropDuplicatesWithinWatermark(["device_id", "metric", "timestampUtc", "missing"])
    stats = reading_window_statistics(readings, layout.window, layout.catalog)
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    if state_partitions:
        spark.conf.set(SHUFFLE_PARTITIONS, str(state_partitions))
    try:
        return _start(layout, stats, native_batch, "gold_native", trigger, mode="update")
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


def _start(layout, frame, handle, name, trigger, mode="append") -> StreamingQuery:
    return (
        frame.writeStream.foreachBatch(lambda batch, batch_id: handle(layout, batch, batch_id))
        .outputMode(mode)
        .option("checkpointLocation", layout.checkpoint(name))
        .trigger(**trigger)
        .start()
    )
