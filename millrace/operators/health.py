"""Health reports: one aggregate per layer instead of one job per figure."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import STATISTICS, Layout
from millrace.operators.figures import totals
from millrace.sources.backfill import all_bronze

# Fixed value: how much of an error text a status row shows.
ERROR_LENGTH = 50

LAYER_STATUS = "layer string, total_records bigint, unique_devices bigint, latest_timestamp timestamp, status string"
GOLD_STATUS = (
    "metric string, total_records bigint, unique_devices bigint, time_windows bigint, "
    "earliest_window timestamp, latest_window timestamp, status string"
)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_summary(frame: DataFrame, layer: str, time_column: str, devices: bool) -> DataFrame:
    unique = F.count_distinct("device_id") if devices else F.lit(None).cast("bigint")
    return frame.agg(
        F.count("*").alias("total_records"),
        unique.alias("unique_devices"),
        F.max(time_column).alias("latest_timestamp"),
    ).select(
        F.lit(layer).alias("layer"),
        "total_records",
        "unique_devices",
        "latest_timestamp",
        F.lit("OK").alias("status"),
    )


def guarded(spark: SparkSession, layer: str, build: Callable[[], DataFrame], run: bool = True) -> DataFrame:
    """The summary of a layer, or a row of zeros with the start of the error text.

    With ``run`` the one summary row is computed here, so that errors of the data count too.
    """
    try:
        summary = build()
        return spark.createDataFrame(summary.collect(), summary.schema) if run else summary
    except Exception as e:
        row = (layer, 0, None, None, f"Error: {str(e)[:ERROR_LENGTH]}")
        return spark.createDataFrame([row], LAYER_STATUS)


def layer_status(spark: SparkSession, layout: Layout, run: bool = True) -> DataFrame:
    def bronze_rows():
        # Errors of a missing layer are reported; one that only backfills filled is not missing.
        return all_bronze(spark, layout) if layout.backfill.exists(spark) else layout.bronze.read(spark)

    def bronze():
        return layer_summary(bronze_rows(), "Bronze", "ingestion_time", devices=False)

    def silver():
        if not layout.figures:
            return layer_summary(layout.silver.read(spark), "Silver", "event_time", devices=True)
        stored = totals(layout.silver_figures.read(spark), ["device"])
        return stored.select(
            F.lit("Silver").alias("layer"),
            F.col("n").alias("total_records"),
            F.col("device").alias("unique_devices"),
            F.col("latest").alias("latest_timestamp"),
            F.lit("OK").alias("status"),
        )

    return guarded(spark, "Bronze", bronze, run).unionByName(guarded(spark, "Silver", silver, run))


def share(part: Column, whole: Column) -> Column:
    """Percentage with one decimal; null when there is nothing to compare with."""
    return F.when(whole > 0, F.round(part / whole * 100, 1))


def rates(*counts: DataFrame) -> DataFrame:
    """Silver as a share of bronze, and what is pending, from one-row counts.

    The ``records`` figures compare rows of the two tables, which are envelopes and wide records;
    the ``readings`` figures compare all readings with the ones that are stored.
    """
    names = ("bronze_records", "silver_records", "bronze_readings", "silver_readings")
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    bronze, silver, bronze_readings, silver_readings = (F.col(n) for n in names)
    return one.agg(*[F.max(n).alias(n) for n in names]).select(
        *names,
        share(silver, bronze).alias("processing_rate"),
        (bronze - silver).alias("records_pending"),
        share(silver_readings, bronze_readings).alias("reading_rate"),
        (bronze_readings - silver_readings).alias("readings_pending"),
    )


def processing_rate(bronze: DataFrame, silver: DataFrame, stored_readings: DataFrame) -> DataFrame:
    size = F.json_array_length("values").cast("bigint")
    return rates(
        bronze.agg(
            F.count("*").alias("bronze_records"),
            F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("bronze_readings"),
        ),
        silver.agg(F.count("*").alias("silver_records")),
        stored_readings.agg(F.count("*").alias("silver_readings")),
    )


def layout_rate(spark: SparkSession, layout: Layout) -> DataFrame:
    """The processing rate of a layout; with its figures, from the ledger and the figures of silver, without bronze.

    The readings that are stored are counted by the footers of their files in either case.
    """
    stored = layout.readings.read(spark)
    if not layout.figures:
        return processing_rate(all_bronze(spark, layout), layout.silver.read(spark), stored)
    taken = F.sum("n").alias("bronze_records"), F.sum("readings").alias("bronze_readings")
    return rates(
        layout.ledger.read(spark).agg(*taken),
        totals(layout.silver_figures.read(spark), ["device"]).select(F.col("n").alias("silver_records")),
        stored.agg(F.count("*").alias("silver_readings")),
    )


def gold_summary(metrics: DataFrame, metric: str) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("device_id").alias("unique_devices"),
        F.count_distinct("window_start").alias("time_windows"),
        F.min("window_start").alias("earliest_window"),
        F.max("window_start").alias("latest_window"),
    ).select(
        F.lit(metric).alias("metric"),
        "total_records",
        "unique_devices",
        "time_windows",
        "earliest_window",
        "latest_window",
        F.when(F.col("total_records") > 0, "active").otherwise("empty").alias("status"),
    )


def gold_status(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per metric table: active, empty, or missing."""

    def row(statistic: str) -> DataFrame:
        table, name = layout.gold(statistic), statistic.upper()
        if layout.figures and layout.gold_figures.exists(spark):
            stored = totals(layout.gold_figures.read(spark), ["device", "window"])
            return stored.select(
                F.lit(name).alias("metric"),
                F.col("n").alias("total_records"),
                F.col("device").alias("unique_devices"),
                F.col("window").alias("time_windows"),
                F.col("earliest").alias("earliest_window"),
                F.col("latest").alias("latest_window"),
                F.when(F.col("n") > 0, "active").otherwise("empty").alias("status"),
            )
        if table.exists(spark):
            return gold_summary(table.read(spark), name)
        return spark.createDataFrame([(name, 0, 0, 0, None, None, "missing")], GOLD_STATUS)

    return union_all(row(s) for s in STATISTICS)

