import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.catalog import WIND_FARM
from millrace.operators.health import guarded, rates
from millrace.operators.lookups import device_counts, of_device, ordered, schema_report
from millrace.operators.readings import explode_readings, reading_quality, valid_readings
from millrace.operators.wide import keep_first, pivot_readings, wide_records, whole_second_records
from millrace.operators.windows import (
    merge_partials,
    one_statistic,
    profile,
    window_partials,
    window_statistics,
)

MINUTE = 1704067200000  # 2024-01-01 00:00Z


def reading(device=1, metric="Wind_speed", at=MINUTE, value=1.0, datatype="float"):
    return {"device_id": device, "metric": metric, "timestampUtc": at, "datatype": datatype, "value": value}


def bronze(spark, *values):
    rows = [(v if isinstance(v, str) or v is None else json.dumps(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "values string, sequence bigint")


def wide(spark, *values):
    readings = explode_readings(bronze(spark, *values), ("sequence",))
    return wide_records(valid_readings(readings), WIND_FARM)


def test_bad_envelopes_give_no_reading(spark):
    frame = bronze(spark, "not json", [], None, "", [reading()])
    assert explode_readings(frame).count() == 1


def test_scalars_become_text(spark):
    values = [6.091, True, "auto", 7, None]
    frame = bronze(spark, [reading(value=v) for v in values])
    found = [r["value"] for r in explode_readings(frame).orderBy("arrival.position").collect()]
    assert found == ["6.091", "true", "auto", "7", None]


def test_one_bad_reading_does_not_lose_the_others(spark):
    frame = bronze(spark, [reading(device="x"), reading(device=2)])
    devices = [r["device_id"] for r in explode_readings(frame).orderBy("arrival.position").collect()]
    assert devices == [None, 2]


def test_quality_counts(spark):
    frame = bronze(
        spark,
        "not json",
        [],
        None,
        [reading(), reading(device=None), reading(metric=None), reading(at=None), reading(at=10**18)],
    )
    row = reading_quality(frame).first().asDict()
    assert row == {
        "envelopes": 4,
        "envelopes_without_readings": 3,
        "readings": 5,
        "without_device": 1,
        "without_metric": 1,
        "without_time": 2,
        "valid_readings": 1,
    }


def test_missing_and_unknown_metrics(spark):
    row = wide(spark, [reading(metric="AirPres", value=990.5), reading(metric="New_metric")]).first()
    assert row["AirPres"] == 990.5
    assert row["Humidity"] is None
    assert "New_metric" not in row


def test_types_of_a_full_record(spark):
    values = {
        "Wind_speed": 6.091, "AirPres": 1000, "Ambient_temperature": -3.5, "Humidity": "41.5", "Power_output": 0,
        "Rotor_rpm": "3.0", "Error_code": "x", "Brake_active": "1", "Grid_connected": True, "Operation_mode": "auto",
    }
    row = wide(spark, [reading(metric=m, value=v) for m, v in values.items()]).first()
    found = [row[n] for n in WIND_FARM.names]
    assert found == [6.091, 1000.0, -3.5, 41.5, 0.0, 3, None, True, True, "auto"]


def test_first_reading_wins_in_any_row_order(spark):
    envelopes = [[reading(value=5), reading(value=4)], [reading(value=3)], [reading(value=None), reading(value=2)]]
    rows = explode_readings(bronze(spark, *envelopes), ("sequence",)).collect()
    schema = explode_readings(bronze(spark, *envelopes), ("sequence",)).schema
    for order in itertools.islice(itertools.permutations(rows), 0, 120, 17):
        frame = spark.createDataFrame(list(order), schema).repartition(3)
        assert wide_records(frame, WIND_FARM).first()["Wind_speed"] == 5.0


def test_null_value_is_no_reading(spark):
    row = wide(spark, [reading(value=None), reading(value=2)]).first()
    assert row["Wind_speed"] == 2.0


def test_same_second_is_two_records_unless_cut(spark):
    frame = wide(spark, [reading(at=MINUTE + 509, value=1), reading(at=MINUTE + 809, value=2)])
    assert frame.count() == 2
    cut = whole_second_records(frame).collect()
    assert [r["Wind_speed"] for r in cut] == [1.0]
    assert whole_second_records(frame).columns == frame.columns


def test_pivot_has_one_shuffle(spark):
    readings = explode_readings(bronze(spark, [reading()]), ("sequence",))
    plan = pivot_readings(readings, WIND_FARM, ("device_id", "timestampUtc"))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1


def test_keep_first(spark):
    frame = spark.createDataFrame([(1, 3, "c"), (1, 2, None), (2, 9, "z"), (None, 1, "n")], "k int, o int, v string")
    found = sorted(map(tuple, keep_first(frame, ["k"], F.col("o")).collect()), key=str)
    assert found == [(1, 2, None), (2, 9, "z"), (None, 1, "n")]


def test_window_edges_and_one_row_window(spark):
    frame = wide(spark, [reading(at=MINUTE + 59_999, value=1), reading(at=MINUTE + 60_000, value=2)])
    rows = window_statistics(frame, "1 minute").orderBy("window_start").collect()
    assert [r["Wind_speed_avg"] for r in rows] == [1.0, 2.0]
    assert [r["Wind_speed_stddev"] for r in rows] == [None, None]
    assert rows[0]["window_end"] == rows[1]["window_start"]


def test_column_order_and_split(spark):
    stats = window_statistics(wide(spark, [reading()]), "1 minute")
    numeric = WIND_FARM.names[:7]
    expected = [f"{n}_{s}" for s in ("avg", "min", "max", "stddev") for n in numeric]
    assert stats.columns == ["device_id", "window_start", "window_end", *expected, "inserted_at"]
    least = one_statistic(stats, "min")
    assert least.columns == ["device_id", "window_start", "window_end", *numeric, "inserted_at"]
    assert dict(least.dtypes)["Rotor_rpm"] == "int"
    assert dict(one_statistic(stats, "avg").dtypes)["Rotor_rpm"] == "double"


def test_profile_takes_numeric_columns_only(spark):
    stats = profile(wide(spark, [reading()]), ["device_id"])
    assert len(stats.columns) == 1 + 7 * 4


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_merged_partials_equal_direct_statistics(spark, shift):
    pick = random.Random(1)
    rows = [
        (d, MINUTE + pick.randrange(180_000), shift + pick.random() if pick.random() < 0.8 else None)
        for d in (1, 2)
        for _ in range(300)
    ] + [(3, MINUTE, None), (4, MINUTE, shift)]
    frame = spark.createDataFrame(rows, "device_id bigint, ms bigint, v double").select(
        "device_id", F.timestamp_millis("ms").alias("event_time"), "v"
    )
    parts = frame.withColumn("part", F.pmod(F.hash("v", "event_time"), F.lit(4)))
    partials = [window_partials(parts.where(F.col("part") == p), "1 minute", ["v"]) for p in range(4)]
    union = partials[0]
    for p in partials[1:]:
        union = union.unionByName(p)
    keys = ["device_id", "window_start"]
    merged = merge_partials(union, ["v"]).orderBy(*keys).collect()
    direct = window_statistics(frame, "1 minute", ["v"]).orderBy(*keys).collect()
    assert len(merged) == len(direct) == 8
    for a, b in zip(merged, direct):
        assert a["v_min"] == b["v_min"] and a["v_max"] == b["v_max"]
        for name in ("v_avg", "v_stddev"):
            assert a[name] == b[name] or a[name] == pytest.approx(b[name], rel=1e-6)


def test_merge_shuffles_once(spark):
    frame = spark.createDataFrame([], "device_id bigint, event_time timestamp, v double")
    merged = merge_partials(window_partials(frame, "1 minute", ["v"]), ["v"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the partials themselves, and the merge


def test_lookups(spark):
    frame = wide(spark, [reading(device=d, at=MINUTE + i) for d, i in [(13, 0), (13, 1), (2, 0)]])
    assert {tuple(r) for r in device_counts(frame).collect()} == {(13, 2), (2, 1)}
    assert of_device(frame, 13).count() == of_device(frame, "13").count() == 2
    metrics = one_statistic(window_statistics(frame, "1 minute"), "avg")
    assert [r["device_id"] for r in ordered(metrics).collect()] == [2, 13]
    report = {r["column_name"]: (r["data_type"], r["non_null"]) for r in schema_report(frame, counts=True).collect()}
    assert schema_report(frame).columns == ["position", "column_name", "data_type"]
    assert report["Wind_speed"] == ("double", 3)
    assert report["Humidity"] == ("double", 0)


def test_rate_of_an_empty_bronze_is_null(spark):
    row = rates(
        spark.createDataFrame([(0, 0)], "bronze_records bigint, bronze_readings bigint"),
        spark.createDataFrame([(0,)], "silver_records bigint"),
        spark.createDataFrame([(0,)], "silver_readings bigint"),
    ).first()
    assert row["processing_rate"] is None and row["reading_rate"] is None and row["records_pending"] == 0


def test_failing_layer_becomes_a_row(spark):
    def broken():
        return spark.range(1).select(F.raise_error(F.lit("x" * 200)).alias("latest_timestamp"))

    row = guarded(spark, "Silver", broken).first()
    assert row["total_records"] == 0
    assert row["status"].startswith("Error: ") and len(row["status"]) == len("Error: ") + 50
