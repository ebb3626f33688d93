"""One query per operator over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import STATISTICS, Layout
from millrace.functions.casts import lenient_cast
from millrace.functions.parsing import json_field
from millrace.functions.times import instant, millis_of_ntz, ntz, whole_second_instant
from millrace.operators.health import (
    gold_status,
    gold_summary,
    guarded,
    layer_status,
    layer_summary,
    layout_rate,
    rates,
    union_all,
)
from millrace.operators.lookups import device_counts, of_device, ordered, schema_report
from millrace.operators.readings import explode_readings, reading_quality, valid_readings
from millrace.operators.state import open_windows
from millrace.operators.wide import keep_first, pivot_readings, whole_second_records
from millrace.operators.windows import (
    merge_partials,
    one_statistic,
    profile,
    window_partials,
    window_statistics,
)
from millrace.operators.edge import rescued_fields
from millrace.plans.batch import backfill, gold_of, rebuild, silver_of
from millrace.plans.standins import (
    EVENT_METRICS,
    bronze_frame,
    by_metric,
    by_third_of_hour,
    envelopes,
    event_layout,
    event_lines,
    hourly_records,
    in_time_order,
    landing_of,
    shown,
    stage,
    stage_lines,
    table,
    telemetry,
)
from millrace.sinks.upsert import upsert
from millrace.sources.backfill import pending_rows
from millrace.sources.landing import top_level_names
from millrace.streaming.bronze import grown, start_bronze
from millrace.streaming.gold import (
    WINDOW_KEY,
    start_gold,
    start_gold_native,
    start_gold_partials,
    start_silver_and_gold,
    with_window_bucket,
)
from millrace.streaming.silver import start_silver

Query = Callable[[SparkSession, str], DataFrame]

DAY = "1 day"
DEVICE = 13


# Scalars, casts, JSON


def json_scalar_extract(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", json_field("props", "k", "int").alias("k"))


def json_array_explode(spark: SparkSession, sf: str) -> DataFrame:
    readings = explode_readings(bronze_frame(telemetry(spark, sf)), ("sequence",))
    return readings.select("device_id", "metric", "timestampUtc", F.col("value").try_cast("double").alias("value"))


def schema_infer_json(spark: SparkSession, sf: str) -> DataFrame:
    return top_level_names(table(spark, sf, "events"), "props")


def epoch_ms_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    millis = table(spark, sf, "events").select("event_id", millis_of_ntz("ts").alias("ms"))
    return millis.select(
        "event_id",
        ntz(instant("ms")).alias("event_time"),
        ntz(whole_second_instant(F.col("ms"))).alias("whole_second"),
    )


def typed_casts(spark: SparkSession, sf: str) -> DataFrame:
    dirty = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    flag = json_field("props", "k", "string")
    return table(spark, sf, "events").select(
        "event_id",
        lenient_cast(dirty, T.DoubleType()).alias("as_double"),
        lenient_cast(dirty, T.IntegerType()).alias("as_int"),
        lenient_cast(flag, T.BooleanType()).alias("as_boolean"),
        lenient_cast(F.col("event_type"), T.StringType()).alias("as_string"),
    )


# Wide records


def pivot_first(spark: SparkSession, sf: str) -> DataFrame:
    return shown(hourly_records(spark, sf))


def silver_whole_seconds(spark: SparkSession, sf: str) -> DataFrame:
    wide = pivot_readings(telemetry(spark, sf), EVENT_METRICS, ("device_id", "timestampUtc"))
    wide = wide.select("device_id", instant("timestampUtc").alias("event_time"), *EVENT_METRICS.names)
    return shown(whole_second_records(wide))


def dedup_keys(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_id", "event_type", "value"
    )
    return keep_first(events, ["user_id", "day"], F.col("event_id"))


# Windows


def tumbling_stats(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("device_id"), F.col("ts").alias("event_time"), "value"
    )
    return shown(window_statistics(events, "1 hour"))


def medallion_batch(spark: SparkSession, sf: str) -> DataFrame:
    """All layers in one plan: JSON text, readings, wide records, hourly statistics."""
    layout = Layout(
        root="unused/", catalog=EVENT_METRICS, order_by=("sequence",), grain="day", window="1 hour"
    )
    return shown(gold_of(silver_of(bronze_frame(telemetry(spark, sf)), layout), layout))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return window_statistics(hourly_records(spark, sf), DAY)


def gold_metric(statistic: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return shown(one_statistic(daily(spark, sf), statistic))

    return query


def numeric_profile(spark: SparkSession, sf: str) -> DataFrame:
    return shown(profile(hourly_records(spark, sf), ["device_id"]))


def merged_partials(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for part in by_third_of_hour(telemetry(spark, sf)):
        rows = part.select(
            "device_id", instant("timestampUtc").alias("event_time"), F.col("value").cast("double").alias("value")
        )
        parts.append(window_partials(rows, "1 hour", ["value"]))
    return shown(merge_partials(union_all(parts), ["value"]))


def gold_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return shown(ordered(one_statistic(daily(spark, sf), "avg")))


def gold_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A metric table built before the error readings came, then corrected by an upsert."""
    layout = event_layout(spark, "upsert", DAY)
    gold = layout.gold("avg")
    full = hourly_records(spark, sf)
    before = full.withColumn("error", F.lit(None).cast("double")).where(
        F.coalesce(*[F.col(n) for n in EVENT_METRICS.names if n != "error"]).isNotNull()
    )

    def averages(records: DataFrame) -> DataFrame:
        return one_statistic(with_window_bucket(window_statistics(records, DAY), layout), "avg")

    upsert(gold, averages(before), WINDOW_KEY, fixed_partition=True)
    upsert(gold, averages(full).where("error is not null"), WINDOW_KEY, fixed_partition=True)
    return shown(gold.read(spark))


# Lookups and health


def counts_per_device(spark: SparkSession, sf: str) -> DataFrame:
    return device_counts(hourly_records(spark, sf))


def device_filter(spark: SparkSession, sf: str) -> DataFrame:
    return shown(of_device(hourly_records(spark, sf), DEVICE))


def events_schema(spark: SparkSession, sf: str) -> DataFrame:
    return schema_report(table(spark, sf, "events"), counts=True)


def quality(spark: SparkSession, sf: str) -> DataFrame:
    """Good envelopes, objects that are no readings, and texts that are no JSON."""
    good = bronze_frame(telemetry(spark, sf)).select("values")
    objects = table(spark, sf, "events").select(F.col("props").alias("values"))
    texts = table(spark, sf, "documents").select(F.col("text").alias("values"))
    return reading_quality(union_all([good, objects, texts]))


def status_of_layers(spark: SparkSession, sf: str) -> DataFrame:
    bronze = envelopes(telemetry(spark, sf)).withColumnRenamed("last_ts", "ingestion_time")
    silver = hourly_records(spark, sf).withColumn("event_time", ntz(F.col("event_time")))
    return union_all(
        [
            layer_summary(bronze, "Bronze", "ingestion_time", devices=False),
            layer_summary(silver, "Silver", "event_time", devices=True),
            guarded(
                spark,
                "Missing",
                lambda: layer_summary(spark.table("absent_layer"), "Missing", "event_time", devices=True),
                run=False,
            ).withColumn("latest_timestamp", F.col("latest_timestamp").cast("timestamp_ntz")),
        ]
    )


def rate(spark: SparkSession, sf: str) -> DataFrame:
    bronze = bronze_frame(telemetry(spark, sf))
    size = F.json_array_length("values").cast("bigint")
    return rates(
        bronze.agg(F.count("*").alias("bronze_records"), F.sum(size).alias("bronze_readings")),
        hourly_records(spark, sf).agg(F.count("*").alias("silver_records")),
        valid_readings(telemetry(spark, sf)).agg(F.count("*").alias("silver_readings")),
    )


def status_of_gold(spark: SparkSession, sf: str) -> DataFrame:
    return shown(union_all(gold_summary(one_statistic(daily(spark, sf), s), s.upper()) for s in STATISTICS))


# Files, streams, rebuild


def stored_readings(bronze: DataFrame) -> DataFrame:
    return explode_readings(bronze, ("ingestion_time", "sequence")).select(
        "device_id",
        "metric",
        "timestampUtc",
        F.col("value").try_cast("double").alias("value"),
        F.col("arrival.ingestion_time").isNotNull().alias("has_ingestion_time"),
    )


def incremental_file_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Readings in the files that the ledger does not hold: those dropped after the first drain."""
    layout = event_layout(spark, "anti")
    first, *later = by_metric(telemetry(spark, sf))
    drop_and_drain(spark, layout, [first])
    for drop in later:
        stage(drop, landing_of(layout))
    return stored_readings(pending_rows(spark, layout, landing_of(layout)))


def bronze_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """What is left over of lines with undeclared and unfit fields, and of lines that are no JSON."""
    layout = event_layout(spark, "rescued")
    stage_lines(event_lines(spark, sf), landing_of(layout))
    stage_lines(table(spark, sf, "documents").select("text").where("text IS NOT NULL"), landing_of(layout))
    start_bronze(spark, layout, landing_of(layout), grow=False, pattern="*.txt").awaitTermination()
    return layout.bronze.read(spark).select("sequence", "rescued")


def rescued_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """How often each field was left over, by type, read from the stored texts as variants."""
    layout = event_layout(spark, "rescued-names")
    stage_lines(event_lines(spark, sf), landing_of(layout))
    start_bronze(spark, layout, landing_of(layout), grow=False, pattern="*.txt").awaitTermination()
    fields = rescued_fields(layout.bronze.read(spark))
    k = F.try_variant_get(F.try_parse_json("value"), "$.k", "bigint")
    kind = F.regexp_extract("type", "^[A-Z]+", 0).alias("type")
    return fields.groupBy("name", kind).agg(F.count("*").alias("n"), F.sum(k).alias("total"))


def schema_growth(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops, the second with fields that the first did not have, as columns of bronze."""
    layout = event_layout(spark, "growth")
    events = table(spark, sf, "events")
    for odd in (0, 1):
        part = events.where(F.col("event_id") % 2 == odd)
        new = [F.col("event_type").alias("site"), F.try_parse_json("props").alias("details")] if odd else []
        lines = part.select(F.to_json(F.struct(F.array("value").alias("values"), F.col("event_id").alias("sequence"), *new)))
        stage_lines(lines, landing_of(layout))
        start_bronze(spark, layout, landing_of(layout), pattern="*.txt").awaitTermination()
    rows = grown(spark, layout).bronze.read(spark)
    return rows.select("sequence", "site", "details", F.col("rescued").isNull().alias("complete"))


def drop_and_drain(spark: SparkSession, layout: Layout, drops: list[DataFrame], *layers: Callable) -> None:
    """Stage each drop as files and let every layer take what is new."""
    for drop in drops:
        stage(drop, landing_of(layout))
        start_bronze(spark, layout, landing_of(layout)).awaitTermination()
        for start in layers:
            start(spark, layout).awaitTermination()


def bronze_append_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "bronze")
    drop_and_drain(spark, layout, [telemetry(spark, sf)])
    return stored_readings(layout.bronze.read(spark))


def bronze_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "two-runs")
    drop_and_drain(spark, layout, in_time_order(telemetry(spark, sf), 2))
    return stored_readings(layout.bronze.read(spark))


def silver_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "silver")
    drop_and_drain(spark, layout, by_metric(telemetry(spark, sf, hourly=True)), start_silver)
    return shown(layout.silver.read(spark))


def silver_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "rebuild")
    drop_and_drain(spark, layout, [telemetry(spark, sf, hourly=True)])
    rebuild(spark, layout)
    return shown(layout.silver.read(spark))


def window_recompute_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "recompute")
    drop_and_drain(spark, layout, by_third_of_hour(telemetry(spark, sf)), start_silver, start_gold)
    return gold_tables(spark, layout)


def window_sharded_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions of a day and a shard of the devices; the late third of each hour rebuilds those it falls into."""
    layout = event_layout(spark, "sharded", shards=2)
    late, *others = by_third_of_hour(telemetry(spark, sf))
    drop_and_drain(spark, layout, [union_all(others), late], start_silver_and_gold)
    return gold_tables(spark, layout)


def window_partials_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "partials")
    drop_and_drain(spark, layout, by_third_of_hour(telemetry(spark, sf)), start_gold_partials)
    return gold_tables(spark, layout)


def window_native_stream(spark: SparkSession, sf: str) -> DataFrame:
    layout = event_layout(spark, "native")
    drop_and_drain(spark, layout, in_time_order(telemetry(spark, sf), 3), start_gold_native)
    return gold_tables(spark, layout)


def backfilled(name: str, *layers: Callable) -> Query:
    """One third through the streams, the rest as a load in parts of a few files, next to it as if another feed had it."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        layout = event_layout(spark, name)
        first, *later = by_third_of_hour(telemetry(spark, sf))
        drop_and_drain(spark, layout, [first], *layers)
        for drop in later:
            stage(drop, landing_of(layout))
        backfill(spark, layout, landing_of(layout), load=1)
        return gold_tables(spark, layout)

    return query


def stored_status(spark: SparkSession, sf: str) -> DataFrame:
    """Status of silver and gold from figures kept by the streams; late rows came in between."""
    layout = event_layout(spark, "figures", figures=True)
    drop_and_drain(spark, layout, by_third_of_hour(telemetry(spark, sf)), start_silver_and_gold)
    silver = layer_status(spark, layout, run=False).where("layer = 'Silver'").select(
        F.col("layer").alias("metric"), "total_records", "unique_devices", F.col("latest_timestamp").alias("latest")
    )
    gold = gold_status(spark, layout).select(
        "metric", "total_records", "unique_devices", "time_windows", F.col("latest_window").alias("latest")
    )
    return shown(silver.unionByName(gold, allowMissingColumns=True))


def stored_rate(spark: SparkSession, sf: str) -> DataFrame:
    """The processing rate from the ledger and the figures of silver; bronze is not read."""
    layout = event_layout(spark, "rate", figures=True)
    drop_and_drain(spark, layout, [telemetry(spark, sf, hourly=True)], start_silver)
    return layout_rate(spark, layout)


def native_open_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The windows in the state of the native stream after its last batch, and its watermark."""
    layout = event_layout(spark, "open")
    drop_and_drain(spark, layout, in_time_order(telemetry(spark, sf), 2), start_gold_native)
    return shown(open_windows(spark, layout))


def gold_tables(spark: SparkSession, layout: Layout) -> DataFrame:
    """The four metric tables stacked, with the name of the statistic."""
    return union_all(
        shown(layout.gold(s).read(spark)).withColumn("statistic", F.lit(s)) for s in STATISTICS
    )


QUERIES: dict[str, Query] = {
    "medallion_batch": medallion_batch,
    "json_scalar_extract": json_scalar_extract,
    "json_array_explode": json_array_explode,
    "schema_infer_json": schema_infer_json,
    "epoch_ms_to_timestamp": epoch_ms_to_timestamp,
    "typed_casts": typed_casts,
    "pivot_first": pivot_first,
    "silver_whole_seconds": silver_whole_seconds,
    "dedup_keys": dedup_keys,
    "tumbling_stats": tumbling_stats,
    **{f"gold_{s}": gold_metric(s) for s in STATISTICS},
    "numeric_profile": numeric_profile,
    "merge_partials": merged_partials,
    "gold_ordered": gold_ordered,
    "gold_upsert": gold_upsert,
    "device_counts": counts_per_device,
    "device_filter": device_filter,
    "schema_report": events_schema,
    "reading_quality": quality,
    "layer_status": status_of_layers,
    "processing_rate": rate,
    "gold_status": status_of_gold,
    "incremental_file_anti": incremental_file_anti,
    "bronze_rescued": bronze_rescued,
    "rescued_by_name": rescued_by_name,
    "schema_growth": schema_growth,
    "backfill_recompute": backfilled("backfill", start_silver, start_gold),
    "backfill_partials": backfilled("backfill-partials", start_gold_partials),
    "bronze_append_stream": bronze_append_stream,
    "bronze_two_runs": bronze_two_runs,
    "silver_stream": silver_stream,
    "silver_rebuild": silver_rebuild,
    "window_recompute_stream": window_recompute_stream,
    "window_sharded_stream": window_sharded_stream,
    "window_partials_stream": window_partials_stream,
    "window_native_stream": window_native_stream,
    "native_open_windows": native_open_windows,
    "stored_status": stored_status,
    "stored_rate": stored_rate,
}
