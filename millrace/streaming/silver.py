"""Bronze to silver: wide records, rebuilt for the partitions a batch touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.catalog import Layout
from millrace.operators.figures import figures
from millrace.operators.readings import explode_readings, valid_readings, with_bucket
from millrace.operators.wide import whole_second_records, wide_records
from millrace.sinks.fanout import computed_once
from millrace.sources.tables import Partitions
from millrace.streaming.bronze import DRAIN


def readings_of(bronze: DataFrame, layout: Layout) -> DataFrame:
    """Valid readings with their storage partition; the same for a stream and for a batch."""
    return with_bucket(valid_readings(explode_readings(bronze, layout.order_by)), layout.grain, layout.shards)


def records_of(readings: DataFrame, layout: Layout) -> DataFrame:
    """Silver records of readings; the same for a stream and for a batch."""
    wide = wide_records(readings, layout.catalog, ("event_bucket",))
    return whole_second_records(wide) if layout.whole_seconds else wide


def silver_figures(silver: DataFrame) -> DataFrame:
    return figures(silver, "event_bucket", "event_time", {"device": F.col("device_id")})


def store_batch(
    layout: Layout, readings: DataFrame, batch_id: int, announce: bool = True
) -> Partitions:
    """Take one batch of readings into silver and tell what it touched. Again changes nothing.

    1. The readings replace partition (bucket, batch), so a replay does not add them twice.
    2. Every touched bucket of silver is rebuilt from all its readings, so that the halves of a
       record that came in two batches meet. Other buckets are not read.
    3. With ``announce`` the touched buckets are told to the gold stream, last, when silver is complete.
    """
    spark = readings.sparkSession
    touched = stored_readings(layout, readings.withColumn("bid", F.lit(batch_id).cast("bigint")), batch_id)
    if touched.values == []:
        return touched
    stored = layout.readings.read_partitions(spark, touched)
    layout.silver.overwrite_partitions(records_of(stored, layout))
    if layout.figures:
        rebuilt = layout.silver.read_partitions(spark, touched)
        layout.silver_figures.overwrite_partitions(silver_figures(rebuilt))
    if announce:
        layout.changes.append(touched.frame.withColumn("bid", F.lit(batch_id)).coalesce(1))
    return touched


def stored_readings(layout: Layout, numbered: DataFrame, batch_id: int) -> Partitions:
    """Write the readings of a batch and tell where they went.

    The folders of a batch are named by its buckets, so that the readings need not be kept to ask for these. One that an
    earlier try of the batch left counts too, and is rebuilt as it is. A catalog table does not show them.
    """
    if layout.readings.is_path:
        layout.readings.overwrite_partitions(numbered)
        return Partitions.of_batch(numbered.sparkSession, layout.readings, batch_id)
    with computed_once(numbered) as batch:
        touched = Partitions.of(batch, "event_bucket")
        if touched.values:
            layout.readings.overwrite_partitions(batch)
        # What is asked of the values later does not need the batch.
        return Partitions.named(batch.sparkSession, "event_bucket", touched.values)


def start_silver(
    spark: SparkSession, layout: Layout, trigger: dict = DRAIN, **limits: str | int
) -> StreamingQuery:
    """``limits`` bound a batch: ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``. Set one where a
    long backlog may wait, since a batch is kept on the executors while it is written."""
    bronze = layout.bronze.read_stream(spark, **limits)
    return (
        readings_of(bronze, layout)
        .writeStream.foreachBatch(lambda batch, batch_id: store_batch(layout, batch, batch_id))
        .option("checkpointLocation", layout.checkpoint("silver"))
        .trigger(**trigger)
        .start()
    )
