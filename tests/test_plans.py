"""The plans are the ones meant: pruned scans, partial aggregates, few shuffles."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import Layout
from millrace.operators.lookups import device_counts, of_device
from millrace.operators.windows import one_statistic, window_statistics
from millrace.plans.batch import gold_of, silver_of
from millrace.plans.queries import QUERIES
from millrace.plans.standins import EVENT_METRICS
from millrace.sinks.upsert import merged
from millrace.sources.tables import Dataset, Partitions


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """Silver of a few devices over six hours."""
    layout = Layout(root=str(tmp_path_factory.mktemp("plans")))
    readings = spark.range(6 * 600).select(
        F.to_json(
            F.array(
                F.struct(
                    (F.col("id") % 50).alias("device_id"),
                    F.lit("Wind_speed").alias("metric"),
                    (F.lit(1704067200000) + F.col("id") * 6_000).alias("timestampUtc"),
                    (F.col("id") % 7).alias("value"),
                )
            )
        ).alias("values"),
        F.lit("f").alias("source_file"),
        F.current_timestamp().alias("ingestion_time"),
    )
    layout.silver.overwrite(silver_of(readings, layout))
    return layout


def test_device_filter_reaches_the_scan(spark, layout):
    found = plan(of_device(layout.silver.read(spark), "13"))
    assert "EqualTo(device_id,13)" in found


def test_device_filter_goes_below_the_aggregate(spark, sf_dir):
    assert "EqualTo(user_id,13)" in plan(QUERIES["device_filter"](spark, sf_dir))


def test_gold_reads_only_keys_and_numbers(spark, layout):
    found = re.search(r"ReadSchema: struct<([^>]*)>", plan(gold_of(layout.silver.read(spark), layout))).group(1)
    assert [c.split(":")[0] for c in found.split(",")] == ["device_id", "event_time", *layout.numeric]


def test_counts_read_only_the_key(spark, layout):
    assert "ReadSchema: struct<device_id:bigint>" in plan(device_counts(layout.silver.read(spark)))


def test_one_statistic_reads_its_columns_only(spark, layout):
    stats = window_statistics(layout.silver.read(spark), "1 minute")
    found = plan(one_statistic(stats, "min"))
    assert "avg(" not in found and "stddev" not in found


def test_few_source_rows_leave_the_target_where_it_is(spark, layout):
    silver = layout.silver.read(spark)
    found = plan(merged(silver, silver.where("device_id = 1"), ["device_id", "event_time"], few=True))
    assert "BroadcastHashJoin" in found and "hashpartitioning" not in found
    assert "hashpartitioning" in plan(merged(silver.hint("merge"), silver.where("device_id = 1"), ["device_id", "event_time"]))


def test_windows_combine_before_the_only_shuffle(spark, layout):
    found = plan(gold_of(layout.silver.read(spark), layout))
    assert found.count("Exchange") == 1
    before = found[found.index("Exchange") :]
    assert "partial_avg" in before


def test_partitions_are_pruned(spark, layout):
    silver = layout.silver.read(spark)
    assert len({f.split("event_bucket=")[1][:13] for f in silver.inputFiles()}) == 6
    one = layout.silver.read_partitions(spark, Partitions(None, ["2024-01-01T03"]))
    assert {f.split("event_bucket=")[1][:13] for f in one.inputFiles()} == {"2024-01-01T03"}
    assert one.count() == 600


def test_files_are_sorted_by_device(spark, layout):
    rows = layout.silver.read_partitions(spark, Partitions(None, ["2024-01-01T03"]))
    ordered = rows.select("device_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    for name in [r["f"] for r in ordered.select("f").distinct().collect()]:
        devices = [r["device_id"] for r in ordered.where(F.col("f") == name).orderBy("i").collect()]
        assert devices == sorted(devices)


@pytest.mark.parametrize("name", ["medallion_batch", "pivot_first", "gold_avg", "dedup_keys", "gold_status"])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    found = plan(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, ENSURE"):
        if word.startswith("Single") and name == "gold_status":
            continue  # one summary row per table ends in one task
        assert word not in found


def test_hash_aggregate_of_the_windows(spark, sf_dir):
    found = plan(QUERIES["tumbling_stats"](spark, sf_dir))
    assert "SortAggregate" not in found and len(EVENT_METRICS.names) == 5


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("part", T.StringType())])
    dataset = Dataset(str(tmp_path / "hot"), schema, ("part",), ("v",))
    rows = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("part"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        dataset.overwrite_partitions(rows)
    finally:
        spark.conf.set(key, before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "hot").glob("part=*")}
    assert len(files) == 41 and files["part=hot"] > 1
    assert dataset.read(spark).count() == 200_000
