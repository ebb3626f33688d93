"""What the writes of a batch cost: files, shuffles and kept rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import Layout, MetricCatalog
from millrace.functions.times import ntz
from millrace.sources.tables import Dataset, Partitions
from millrace.streaming import gold, silver

HOUR = 1704067200000
HOURS = 3


@pytest.fixture
def layout(tmp_path):
    return Layout(root=str(tmp_path / "store"), catalog=MetricCatalog.of(heat=T.DoubleType()), window="1 minute", figures=True)


def envelopes(spark, devices=40):
    """One row of bronze per hour, with a reading of every device."""
    reading = F.struct(
        F.col("id").alias("device_id"),
        F.lit("heat").alias("metric"),
        (F.lit(HOUR) + F.col("hour") * 3_600_000).alias("timestampUtc"),
        F.col("id").cast("double").alias("value"),
    )
    rows = spark.range(devices).crossJoin(spark.range(HOURS).withColumnRenamed("id", "hour"))
    texts = rows.groupBy("hour").agg(F.to_json(F.collect_list(reading)).alias("values"))
    return texts.select(F.lit("f").alias("source_file"), F.timestamp_millis(F.lit(HOUR)).alias("ingestion_time"), "values")


def take(spark, layout, devices=40, batch=0):
    stamps = {"ingestion_date": F.lit("2024-01-01"), "bid": F.lit(batch)}
    layout.bronze.overwrite_partitions(envelopes(spark, devices).withColumn("rescued", F.lit(None)).withColumns(stamps))


def test_batches_of_the_native_stream_write_one_file_a_partition(spark, layout, tmp_path):
    take(spark, layout)
    gold.start_gold_native(spark, layout).awaitTermination()
    for statistic in ("avg", "stddev"):
        written = layout.gold(statistic)
        assert written.read(spark).count() == 40 * HOURS
        folders = [f for f in (tmp_path / "store" / f"metrics_{statistic}").iterdir() if f.is_dir()]
        assert [len(list(f.glob("*.parquet"))) for f in folders] == [1] * HOURS


def test_few_rows_have_a_small_bloom_filter(spark, tmp_path):
    schema = T.StructType([T.StructField("device_id", T.LongType()), T.StructField("day", T.StringType())])
    found = Dataset(str(tmp_path / "found"), schema, ("day",), ("device_id",), ("device_id",))
    found.overwrite_partitions(spark.range(2_000).select((F.col("id") * 7_919).alias("device_id"), F.lit("d").alias("day")))
    assert sum(f.stat().st_size for f in (tmp_path / "found").rglob("*.parquet")) < 100_000
    assert found.read(spark).where("device_id = 7919").count() == 1


def test_windows_are_arranged_once_for_all_tables(spark, layout, monkeypatch):
    arranged = []
    plain = Dataset._arranged
    monkeypatch.setattr(Dataset, "_arranged", lambda self, frame: arranged.append(self.location) or plain(self, frame))
    rows = spark.range(8).select(
        F.col("id").alias("device_id"),
        F.timestamp_millis(F.lit(HOUR)).alias("event_time"),
        F.col("id").cast("double").alias("heat"),
        F.lit(None).cast("timestamp").alias("inserted_at"),
        F.lit("2024-01-01T00").alias("event_bucket"),
    )
    layout.silver.overwrite_partitions(rows)
    arranged.clear()
    gold.recompute_windows(spark, layout, Partitions.named(spark, "event_bucket", ["2024-01-01T00"]))
    assert not [x for x in arranged if "metrics_" in x and "figures" not in x]
    assert layout.gold("max").read(spark).agg(F.sum("heat")).first()[0] == 28
    assert layout.gold_figures.read(spark).where("kind = 'device'").agg(F.sum("n")).first()[0] == 8


def test_readings_of_a_batch_are_not_kept_to_know_their_partitions(spark, layout, monkeypatch):
    monkeypatch.delattr(silver, "computed_once")
    take(spark, layout)
    readings = silver.readings_of(layout.bronze.read(spark), layout)
    touched = silver.store_batch(layout, readings, 0)
    assert touched.values == [f"2024-01-01T{h:02}" for h in range(HOURS)]
    assert layout.silver.read(spark).count() == 40 * HOURS
    assert {r[0] for r in layout.changes.read(spark).select("event_bucket").collect()} == set(touched.values)
    assert silver.store_batch(layout, readings.where("false"), 1).values == []


def test_times_without_zone_are_exact_and_need_no_decimals(spark):
    micros = [None, 0, -1, 253402300799999999, -62135596800000000, 1711846800000001]
    frame = spark.createDataFrame([(m,) for m in micros], "m bigint").select(ntz(F.timestamp_micros("m")).alias("t"))
    assert "decimal" not in frame._jdf.queryExecution().optimizedPlan().toString().lower()
    shown = [r[0] for r in frame.select(F.col("t").cast("string")).collect()]
    assert shown == [None, "1970-01-01 00:00:00", "1969-12-31 23:59:59.999999", "9999-12-31 23:59:59.999999",
                     "0001-01-01 00:00:00", "2024-03-31 01:00:00.000001"]
