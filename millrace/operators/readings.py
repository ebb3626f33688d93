"""Envelopes to readings: parse, explode, check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.parsing import parse_readings
from millrace.functions.times import bucket_of_millis, in_range, in_shards


def explode_readings(envelopes: DataFrame, order_by: tuple[str, ...] = (), text: str = "values") -> DataFrame:
    """One row per reading. Envelopes with bad text, or without readings, give none.

    ``arrival`` says which of two equal readings came first: the ``order_by`` columns of the
    envelope, then the position in it. Narrow: no shuffle, works on a stream.
    """
    exploded = envelopes.select(
        *order_by, F.posexplode(parse_readings(text)).alias("position", "reading")
    )
    return exploded.select(
        F.col("reading.device_id"),
        F.col("reading.metric"),
        F.col("reading.value"),
        F.col("reading.timestampUtc"),
        F.struct(*order_by, "position").alias("arrival"),
    )


def is_valid() -> Column:
    """A reading that can be placed: it has a device, a metric and a possible time."""
    placed = in_range(F.col("timestampUtc"))
    return F.col("device_id").isNotNull() & F.col("metric").isNotNull() & F.coalesce(placed, F.lit(False))


def valid_readings(readings: DataFrame) -> DataFrame:
    return readings.where(is_valid())


def with_bucket(readings: DataFrame, grain: str, shards: int = 1) -> DataFrame:
    bucket = bucket_of_millis(F.col("timestampUtc"), grain)
    return readings.withColumn("event_bucket", in_shards(bucket, "device_id", shards))


def reading_quality(bronze: DataFrame, text: str = "values") -> DataFrame:
    """Counts of envelopes and readings, kept and rejected, in one pass over bronze.

    ``explode_outer`` keeps envelopes that hold nothing, which a plain explode loses silently.
    """
    rows = bronze.select(
        F.col(text).isNotNull().alias("has_text"),
        F.posexplode_outer(parse_readings(text)).alias("position", "reading"),
    ).select("has_text", "position", "reading.*")
    first = F.coalesce(F.col("position"), F.lit(0)) == 0
    is_reading = F.col("position").isNotNull()
    return rows.agg(
        F.count_if(first).alias("envelopes"),
        F.count_if(~is_reading).alias("envelopes_without_readings"),
        F.count_if(is_reading).alias("readings"),
        F.count_if(is_reading & F.col("device_id").isNull()).alias("without_device"),
        F.count_if(is_reading & F.col("metric").isNull()).alias("without_metric"),
        F.count_if(is_reading & ~F.coalesce(in_range(F.col("timestampUtc")), F.lit(False))).alias(
            "without_time"
        ),
        F.count_if(is_reading & is_valid()).alias("valid_readings"),
    )
