"""Readings to wide records: one row per device and instant, one typed column per metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.catalog import MetricCatalog
from millrace.functions.casts import lenient_cast
from millrace.functions.times import instant


def first_text(metric: str) -> Column:
    """The earliest non-null text of a metric in the group.

    The minimum of (arrival, text) is the same for every order of rows, combines on the map side,
    and needs one small aggregate per metric.
    """
    mine = (F.col("metric") == metric) & F.col("value").isNotNull()
    return F.min(F.when(mine, F.struct("arrival", "value"))).getField("value")


def pivot_readings(readings: DataFrame, catalog: MetricCatalog, keys: tuple[str, ...]) -> DataFrame:
    """Long to wide in one shuffle, with the fixed columns of the catalog.

    A metric that no reading of the batch has gives a null column; a metric outside the catalog
    gives no column.
    """
    texts = [first_text(m.name).alias(m.name) for m in catalog.metrics]
    wide = readings.groupBy(*keys).agg(*texts)
    return wide.select(*keys, *[lenient_cast(F.col(m.name), m.data_type).alias(m.name) for m in catalog.metrics])


def wide_records(readings: DataFrame, catalog: MetricCatalog, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """The silver record: keys, metrics and the time of the build."""
    wide = pivot_readings(readings, catalog, ("device_id", "timestampUtc", *extra_keys))
    return wide.select(
        "device_id",
        instant("timestampUtc").alias("event_time"),
        *catalog.names,
        F.current_timestamp().alias("inserted_at"),
        *extra_keys,
    )


def keep_first(frame: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the one with the smallest order.

    An aggregate, not a ranking: a key with very many rows is cut down on the map side.
    """
    rest = [c for c in frame.columns if c not in keys]
    first = F.min_by(F.struct(*rest), order).alias("first")
    return frame.groupBy(*keys).agg(first).select(*keys, "first.*").select(frame.columns)


def whole_second_records(wide: DataFrame) -> DataFrame:
    """Compatibility form: times cut to whole seconds, then one record per device and second.

    The default keeps milliseconds; here two readings of one second become one, the earlier.
    """
    cut = wide.withColumn("_exact", F.col("event_time")).withColumn(
        "event_time", F.date_trunc("second", "event_time")
    )
    return keep_first(cut, ["device_id", "event_time"], F.col("_exact")).drop("_exact")
