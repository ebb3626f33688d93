"""Looking into the state of a stream, from its checkpoint, while it runs or not. Nothing is changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import Layout
from millrace.functions.parsing import json_field

WINDOWS = "stateStoreSave"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per operator that keeps state: operator_id, operator, store, partitions, first_batch, last_batch."""
    return (
        spark.read.format("state-metadata")
        .load(checkpoint)
        .select(
            F.col("operatorId").alias("operator_id"),
            F.col("operatorName").alias("operator"),
            F.col("stateStoreName").alias("store"),
            F.col("numPartitions").alias("partitions"),
            F.col("minBatchId").alias("first_batch"),
            F.col("maxBatchId").alias("last_batch"),
        )
    )


def state_rows(spark: SparkSession, checkpoint: str, operator_id: int) -> DataFrame:
    """key, value and partition_id of what an operator keeps after the last batch."""
    return spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)


def state_sizes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows in each partition of each operator's state, also where there are none: shows skew and growth."""

    def sizes(operator) -> DataFrame:
        places = spark.range(operator["partitions"]).select(F.col("id").cast("int").alias("partition_id"))
        counted = state_rows(spark, checkpoint, operator["operator_id"]).groupBy("partition_id").agg(F.count("*").alias("n"))
        return places.join(counted, "partition_id", "left").select(
            F.lit(operator["operator_id"]).cast("bigint").alias("operator_id"),
            F.lit(operator["operator"]).alias("operator"),
            "partition_id",
            F.coalesce("n", F.lit(0)).alias("state_rows"),
        )

    # As many operators as the query has.
    return reduce(DataFrame.unionByName, [sizes(o) for o in state_operators(spark, checkpoint).collect()])


def watermark(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row with the time that a stream counts as past; null before it has any."""
    logged = spark.read.text(f"{checkpoint}/offsets").where(F.ltrim("value").startswith("{"))
    # It never falls, so the last is the largest; 0 stands for none.
    millis = F.max(json_field("value", "batchWatermarkMs", "bigint"))
    return logged.agg(F.timestamp_millis(F.nullif(millis, F.lit(0))).alias("watermark"))


def open_windows(spark: SparkSession, layout: Layout) -> DataFrame:
    """The windows that the native stream keeps open: device_id, window_start, window_end, watermark.

    Rows for them still count; those of any other past window are dropped.
    """
    checkpoint = layout.checkpoint("gold_native")
    (operator,) = state_operators(spark, checkpoint).where(F.col("operator") == WINDOWS).collect()
    windows = state_rows(spark, checkpoint, operator["operator_id"]).select(
        "key.device_id", F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end")
    )
    return windows.crossJoin(F.broadcast(watermark(spark, checkpoint)))
