"""Small queries over a layer: counts, one device, ordered listing, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import device_shard


def device_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("device_id").agg(F.count("*").alias("info_count"))


def of_device(rows: DataFrame, device_id: int | str, shards: int = 1, bucket: str = "event_bucket") -> DataFrame:
    """All columns of one device. The key is compared as a number, so that the scan can use it.

    With the shards of the layout, and the column of its partitions, only those of the device's shard are read.
    """
    device = F.lit(int(device_id)).cast("bigint")
    found = rows.where(F.col("device_id") == device)
    return found if shards == 1 else found.where(F.endswith(F.col(bucket), F.concat(F.lit("_"), device_shard(device, shards))))


def ordered(metrics: DataFrame) -> DataFrame:
    """A metric table by device, then window, so that the order is total."""
    return metrics.orderBy("device_id", "window_start")


def schema_report(frame: DataFrame, counts: bool = False) -> DataFrame:
    """Position, name and type of every column, without reading a row; with ``counts`` also the
    number of non-null values, in one pass."""
    fields = frame.schema.fields
    if not counts:
        rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
        return frame.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")
    counts = frame.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("non_null"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(rows))
