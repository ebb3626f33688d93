"""Reports that read no layer: figures kept beside partitions, and the state of a stream; look-ups that read no row."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import Layout
from millrace.operators.figures import figures, totals
from millrace.operators.health import gold_status, layer_status, layout_rate
from millrace.operators.state import open_windows, state_operators, state_sizes, watermark
from millrace.plans.batch import rebuild
from millrace.sources.tables import Dataset
from millrace.streaming.bronze import start_bronze
from millrace.streaming.gold import start_gold, start_gold_native, start_gold_partials, start_silver_and_gold
from millrace.streaming.silver import start_silver

HOUR = 3_600_000


def drop(folder, name, *readings):
    folder.mkdir(parents=True, exist_ok=True)
    rows = [{"device_id": d, "metric": "Wind_speed", "timestampUtc": at, "value": v} for d, at, v in readings]
    (folder / name).write_text(json.dumps({"values": rows}))


def test_figures_add_up_over_partitions(spark):
    rows = spark.range(-70_000, 70_000, 7).select(
        (F.col("id") % 40_000).alias("number"), F.timestamp_seconds("id").alias("time"), F.col("id").cast("string").substr(-1, 1).alias("bucket")
    )
    stored = figures(rows, "bucket", "time", {"a": F.col("number"), "b": F.floor(F.col("number") / 100)})
    expected = rows.agg(
        F.count("*"), F.min("time"), F.max("time"), F.count_distinct("number"), F.count_distinct(F.floor(F.col("number") / 100))
    )
    assert tuple(totals(stored, ["a", "b"]).first()) == tuple(expected.first())
    some = stored.where("bucket IN ('1', '4')")
    expected = rows.where("bucket IN ('1', '4')").agg(F.count_distinct("number")).first()[0]
    assert totals(some, ["a", "b"]).first()["a"] == expected
    assert tuple(totals(stored.where("false"), ["a", "b"]).first()) == (0, None, None, 0, 0)


@pytest.mark.parametrize("layers", [[start_silver, start_gold], [start_silver_and_gold], [start_silver, start_gold_partials]])
def test_status_from_figures_equals_status_from_rows(spark, tmp_path, layers):
    layout, landing = Layout(root=str(tmp_path / "store"), figures=True), tmp_path / "landing"
    plain = Layout(root=str(tmp_path / "store"))

    def same():
        silver = layer_status(spark, layout, run=False).where("layer = 'Silver'")
        assert silver.collect() == layer_status(spark, plain, run=False).where("layer = 'Silver'").collect()
        assert sorted(gold_status(spark, layout).collect()) == sorted(gold_status(spark, plain).collect())
        read = [p for f in (silver, gold_status(spark, layout)) for p in f.inputFiles()]
        assert read and all("_figures/" in p for p in read if "/bronze/" not in p)

    drop(landing, "a.json", (1, 0, 5), (-3, 10, 6), (40_000, HOUR, 7))
    for _ in range(2):
        start_bronze(spark, layout, str(landing)).awaitTermination()
        for start in layers:
            start(spark, layout).awaitTermination()
        same()
        # Late rows: a new device and a new window in an old partition, and a device that another partition has.
        drop(landing, "b.json", (2, 90_000, 5), (1, HOUR + 5, 6))
    assert layer_status(spark, layout).where("layer = 'Silver'").first()["unique_devices"] == 4
    rate = layout_rate(spark, layout)
    assert rate.collect() == layout_rate(spark, plain).collect()
    assert not any("/bronze/" in p for p in rate.inputFiles())
    rebuild(spark, layout)
    same()


def test_the_state_of_the_native_stream(spark, tmp_path):
    layout, landing = Layout(root=str(tmp_path / "store"), watermark="30 seconds"), tmp_path / "landing"
    drop(landing, "a.json", *[(d, 1_000 * d + 1, 1) for d in range(20)])
    start_bronze(spark, layout, str(landing)).awaitTermination()
    start_gold_native(spark, layout, state_partitions=3).awaitTermination()
    checkpoint = layout.checkpoint("gold_native")
    assert {r["operator"] for r in state_operators(spark, checkpoint).collect()} == {"stateStoreSave", "dedupeWithinWatermark"}
    sizes = state_sizes(spark, checkpoint)
    assert sizes.count() == 6
    assert sizes.where("operator = 'stateStoreSave'").agg(F.sum("state_rows")).first()[0] == 20
    assert open_windows(spark, layout).count() == 20

    drop(landing, "b.json", (1, HOUR, 2))
    start_bronze(spark, layout, str(landing)).awaitTermination()
    start_gold_native(spark, layout).awaitTermination()
    found = open_windows(spark, layout).select("device_id", F.unix_millis("window_start"), F.unix_millis("window_end"), F.unix_millis("watermark"))
    assert [tuple(r) for r in found.collect()] == [(1, HOUR, HOUR + 60_000, HOUR - 30_000)]
    assert watermark(spark, checkpoint).count() == 1
    assert state_sizes(spark, checkpoint).where("operator = 'stateStoreSave'").agg(F.sum("state_rows")).first()[0] == 1


def test_a_look_up_of_an_absent_device_reads_no_row(spark, tmp_path):
    """Inside the range of the file's devices, and with too many of them for a dictionary."""
    schema = T.StructType().add("device_id", "long").add("v", "double").add("part", "string")
    rows = spark.range(0, 800_000, 2).select(F.col("id").alias("device_id"), F.rand(1).alias("v"), F.lit("p").alias("part"))

    def rows_read(dataset, device):
        found = dataset.read(spark).where(F.col("device_id") == device)
        n = len(found.collect())
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return n, scan.metrics().apply("numOutputRows").value()

    absent = [100_001 + 50_002 * i for i in range(10)]
    with_filter = Dataset(str(tmp_path / "with"), schema, ("part",), ("device_id",), ("device_id",))
    with_filter.overwrite_partitions(rows)
    assert sum(rows_read(with_filter, d)[1] == 0 for d in absent) >= 8
    assert rows_read(with_filter, 100_002)[0] == 1
    without = Dataset(str(tmp_path / "without"), schema, ("part",), ("device_id",))
    without.overwrite_partitions(rows)
    assert all(rows_read(without, d)[1] > 0 for d in absent)
