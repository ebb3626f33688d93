"""The ``events`` table as device telemetry: users are devices, event types are metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import Layout, MetricCatalog
from millrace.functions.times import instant, millis_of_ntz, ntz
from millrace.operators.wide import pivot_readings
from millrace.session import scratch_folder

EVENT_METRICS = MetricCatalog.of(
    click=T.DoubleType(),
    error=T.DoubleType(),
    purchase=T.DoubleType(),
    signup=T.DoubleType(),
    view=T.DoubleType(),
)

LANDING = T.StructType(
    [T.StructField("values", T.StringType()), T.StructField("sequence", T.LongType())]
)

# Event ids per envelope. Ids are unique, so an envelope never holds more readings than this.
ENVELOPE_IDS = 256

HOUR_MILLIS = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str, hourly: bool = False) -> DataFrame:
    """Long readings of ``events``. ``hourly`` moves each to the start of its hour, so that the
    metrics of one user and hour form one wide record."""
    millis = millis_of_ntz("ts")
    if hourly:
        millis = F.floor(millis / HOUR_MILLIS) * HOUR_MILLIS
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("metric"),
        F.col("value").cast("string").alias("value"),
        millis.alias("timestampUtc"),
        F.struct("event_id").alias("arrival"),
        "ts",
    )


def envelopes(readings: DataFrame) -> DataFrame:
    """Readings packed as devices send them: arrays of at most ``ENVELOPE_IDS`` readings."""
    event_id = F.col("arrival.event_id")
    reading = F.struct(
        "device_id",
        "metric",
        "timestampUtc",
        F.lit("float").alias("datatype"),
        F.col("value").cast("double").alias("value"),
    )
    packed = readings.groupBy(F.floor(event_id / ENVELOPE_IDS).alias("sequence")).agg(
        F.sort_array(F.collect_list(F.struct(event_id.alias("event_id"), reading.alias("reading")))).alias("rows"),
        F.max("ts").alias("last_ts"),
    )
    return packed.select(F.col("rows.reading").alias("values"), "sequence", "last_ts")


def bronze_frame(readings: DataFrame) -> DataFrame:
    """Envelopes as bronze holds them, without a detour over files."""
    return envelopes(readings).select(
        F.to_json("values").alias("values"), "sequence", F.col("last_ts").alias("ingestion_time")
    )


def stage(readings: DataFrame, landing: str) -> None:
    """Drop readings as JSON files into a landing folder."""
    envelopes(readings).select("values", "sequence").write.mode("append").json(landing)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of JSON per event: a reading, a sequence that is no number for errors, and a field that no schema declares."""
    events = table(spark, sf_dir, "events")
    reading = F.struct(
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("metric"),
        millis_of_ntz("ts").alias("timestampUtc"),
        F.lit("float").alias("datatype"),
        "value",
    )
    values, details = F.array(reading).alias("values"), F.try_parse_json("props").alias("props")
    event_id = F.col("event_id")
    unfit = F.to_json(F.struct(values, F.concat(F.lit("x"), event_id).alias("sequence"), details))
    fit = F.to_json(F.struct(values, event_id.alias("sequence"), details))
    return events.select(F.when(F.col("event_type") == "error", unfit).otherwise(fit).alias("line"))


def stage_lines(lines: DataFrame, landing: str) -> None:
    """Drop texts as they are into a landing folder, as ``*.txt`` files."""
    lines.write.mode("append").text(landing)


def landing_of(layout: Layout) -> str:
    return f"{layout.root}/landing"


def event_layout(spark: SparkSession, name: str, window: str = "1 hour", **more) -> Layout:
    return Layout(
        root=scratch_folder(spark, name),
        catalog=EVENT_METRICS,
        landing_schema=LANDING,
        order_by=("sequence",),
        grain="day",
        window=window,
        **more,
    )


def by_metric(readings: DataFrame) -> list[DataFrame]:
    """Three drops; the metrics of one record arrive in different ones."""
    first, second = ["view", "click"], ["purchase", "signup"]
    metric = F.col("metric")
    rest = ~metric.isin(first + second)
    return [readings.where(metric.isin(first)), readings.where(metric.isin(second)), readings.where(rest)]


def by_third_of_hour(readings: DataFrame) -> list[DataFrame]:
    """Three drops, last third of every hour first: each window is filled by three batches."""
    minute = F.minute("ts")
    return [
        readings.where(minute >= 40),
        readings.where(minute < 20),
        readings.where((minute >= 20) & (minute < 40)),
    ]


def in_time_order(readings: DataFrame, parts: int) -> list[DataFrame]:
    """Drops that follow one another in time, cut at even steps of the whole span."""
    first, last = readings.agg(F.min("timestampUtc"), F.max("timestampUtc")).first()
    edges = [first + (last + 1 - first) * i // parts for i in range(parts + 1)]
    time = F.col("timestampUtc")
    return [readings.where((time >= a) & (time < b)) for a, b in zip(edges, edges[1:])]


def hourly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver records of users and hours."""
    keys = ("device_id", "timestampUtc")
    wide = pivot_readings(telemetry(spark, sf_dir, hourly=True), EVENT_METRICS, keys)
    return wide.select("device_id", instant("timestampUtc").alias("event_time"), *EVENT_METRICS.names)


def shown(frame: DataFrame) -> DataFrame:
    """Comparable output: instants as UTC wall-clock time, doubles with 6 digits, no stamps."""

    def show(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = ntz(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        return c.alias(f.name)

    hidden = ("inserted_at", "event_bucket", "window_bucket")
    return frame.select(*[show(f) for f in frame.schema.fields if f.name not in hidden])
