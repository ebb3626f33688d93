"""Streams, batch twins and replays over small landing folders."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.catalog import STATISTICS, Layout
from millrace.operators.health import gold_status, layer_status, processing_rate
from millrace.operators.lookups import of_device
from millrace.plans import compaction
from millrace.plans.batch import all_bronze, backfill, gold_of, rebuild, register_views, silver_of
from millrace.sources import tables
from millrace.streaming.bronze import start_bronze
from millrace.streaming.gold import (
    recompute_batch,
    start_gold,
    start_gold_native,
    start_gold_partials,
    start_silver_and_gold,
)
from millrace.streaming.silver import readings_of, start_silver, store_batch

MINUTE = 1704067200000
METRICS = {
    "Wind_speed": 6.5, "AirPres": 1001.5, "Ambient_temperature": 3.25, "Humidity": 40.5, "Power_output": 900.0,
    "Rotor_rpm": 12, "Error_code": 0, "Brake_active": False, "Grid_connected": True, "Operation_mode": "auto",
}


def reading(device=1, metric="Wind_speed", at=MINUTE, value=1.0):
    return {"device_id": device, "metric": metric, "timestampUtc": at, "datatype": "x", "value": value}


def drop(folder, name, *envelopes):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(e if isinstance(e, str) else json.dumps({"values": e}) for e in envelopes)
    (folder / name).write_text(text)


@pytest.fixture(params=["folder", "table"])
def layout(request, spark, tmp_path):
    database = None
    if request.param == "table":
        database = "t_" + tmp_path.name.replace("-", "_").replace("[", "_").replace("]", "_")
        spark.sql(f"CREATE DATABASE {database}")
    return Layout(root=str(tmp_path / "store"), database=database)


@pytest.fixture
def folder_layout(tmp_path):
    return Layout(root=str(tmp_path / "store"))


def run(spark, layout, landing, *layers):
    start_bronze(spark, layout, str(landing)).awaitTermination()
    for start in layers:
        start(spark, layout).awaitTermination()


def silver_rows(spark, layout):
    names = ["device_id", "event_time", *layout.catalog.names]
    return sorted(map(tuple, layout.silver.read(spark).select(names).collect()))


def gold_rows(spark, layout, statistic="avg", names=("Wind_speed",)):
    rows = layout.gold(statistic).read(spark).select("device_id", F.unix_millis("window_start"), *names)
    return sorted(map(tuple, rows.collect()))


def test_layers_end_to_end(spark, layout, tmp_path):
    landing = tmp_path / "landing"
    full = [reading(metric=m, value=v) for m, v in METRICS.items()]
    drop(landing, "a.json", full, [reading(device=None), reading(metric="New_metric", value=1)], "{broken")
    run(spark, layout, landing, start_silver, start_gold)
    rows = silver_rows(spark, layout)
    assert [r[2:] for r in rows] == [tuple(METRICS.values())]
    kept = layout.readings.read(spark)
    assert kept.where("metric = 'New_metric'").count() == 1
    assert kept.where("device_id is null").count() == 0
    assert gold_rows(spark, layout, "min", ("Wind_speed", "Rotor_rpm")) == [(1, MINUTE, 6.5, 12)]
    assert gold_rows(spark, layout, "stddev") == [(1, MINUTE, None)]

    # Nothing new: no change and no failure.
    run(spark, layout, landing, start_silver, start_gold)
    assert silver_rows(spark, layout) == rows
    assert layout.bronze.read(spark).count() == 3

    # A late reading of the same window, and one of a new window.
    drop(landing, "b.json", [reading(at=MINUTE + 1, value=7.5), reading(at=MINUTE + 60_000, value=3)])
    run(spark, layout, landing, start_silver, start_gold)
    assert gold_rows(spark, layout) == [(1, MINUTE, 7.0), (1, MINUTE + 60_000, 3.0)]

    status = {r["layer"]: r for r in layer_status(spark, layout).collect()}
    assert status["Bronze"]["total_records"] == 4 and status["Bronze"]["unique_devices"] is None
    assert status["Silver"]["total_records"] == 3 and status["Silver"]["unique_devices"] == 1
    assert {r["status"] for r in status.values()} == {"OK"}
    rate = processing_rate(layout.bronze.read(spark), layout.silver.read(spark), layout.readings.read(spark)).first()
    assert (rate["bronze_records"], rate["silver_records"], rate["processing_rate"]) == (4, 3, 75.0)
    assert (rate["bronze_readings"], rate["silver_readings"], rate["readings_pending"]) == (14, 13, 1)
    gold = gold_status(spark, layout).collect()
    assert [r["metric"] for r in gold] == ["AVG", "MIN", "MAX", "STDDEV"]
    assert all(r["status"] == "active" and r["total_records"] == 2 and r["time_windows"] == 2 for r in gold)


def test_missing_and_empty_layers(spark, folder_layout):
    layout = folder_layout
    status = layer_status(spark, layout).collect()
    assert all(r["total_records"] == 0 and r["status"].startswith("Error: ") for r in status)
    layout.gold("avg").overwrite_partitions(layout.gold("avg").empty(spark))
    found = {r["metric"]: r["status"] for r in gold_status(spark, layout).collect()}
    assert found == {"AVG": "empty", "MIN": "missing", "MAX": "missing", "STDDEV": "missing"}


@pytest.mark.parametrize("layers", [[start_silver, start_gold], [start_silver_and_gold], [start_gold_partials]])
def test_late_rows_correct_their_window(spark, tmp_path, layers):
    layout, landing = Layout(root=str(tmp_path / "store")), tmp_path / "landing"
    for name, values in [("a", [10, 20]), ("b", [60]), ("c", [100])]:
        at = {10: 0, 20: 10_000, 60: 20_000, 100: 30_000}
        drop(landing, f"{name}.json", [reading(at=MINUTE + at[v], value=v) for v in values])
        run(spark, layout, landing, *layers)
    assert gold_rows(spark, layout) == [(1, MINUTE, 47.5)]
    assert gold_rows(spark, layout, "min") == [(1, MINUTE, 10.0)]
    assert gold_rows(spark, layout, "max") == [(1, MINUTE, 100.0)]


def test_native_state_drops_rows_behind_the_watermark(spark, tmp_path):
    layout, landing = Layout(root=str(tmp_path / "store")), tmp_path / "landing"
    drop(landing, "a.json", [reading(at=MINUTE, value=10), reading(at=MINUTE + 600_000, value=50)])
    run(spark, layout, landing, start_gold_native)
    drop(landing, "b.json", [reading(at=MINUTE + 1, value=90), reading(at=MINUTE + 600_001, value=70)])
    run(spark, layout, landing, start_gold_native)
    assert gold_rows(spark, layout) == [(1, MINUTE, 10.0), (1, MINUTE + 600_000, 60.0)]
    assert gold_rows(spark, layout, "min", ("Rotor_rpm",))[0][2] is None


def test_native_state_counts_a_repeated_reading_once(spark, tmp_path):
    layout, landing = Layout(root=str(tmp_path / "store")), tmp_path / "landing"
    once = reading(value=10)
    drop(landing, "a.json", [once, once, reading(at=MINUTE + 5_000, value=20)])
    run(spark, layout, landing, start_gold_native)
    drop(landing, "b.json", [once, reading(at=MINUTE + 6_000, value=60)])
    run(spark, layout, landing, start_gold_native)
    assert gold_rows(spark, layout) == [(1, MINUTE, 30.0)]


def test_record_split_over_batches_becomes_one(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    items = list(METRICS.items())
    drop(landing, "a.json", [reading(metric=m, value=v) for m, v in items[:5]])
    run(spark, layout, landing, start_silver)
    drop(landing, "b.json", [reading(metric=m, value=v) for m, v in items[5:]])
    run(spark, layout, landing, start_silver)
    assert [r[2:] for r in silver_rows(spark, layout)] == [tuple(METRICS.values())]


def test_replay_changes_nothing(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading(at=MINUTE + i, value=i) for i in range(5)])
    run(spark, layout, landing, start_silver, start_gold)
    silver, gold = silver_rows(spark, layout), gold_rows(spark, layout)
    for _ in range(2):
        store_batch(layout, readings_of(layout.bronze.read(spark), layout), 0)
        recompute_batch(layout, layout.silver.read(spark).select("event_bucket"), 0)
    assert silver_rows(spark, layout) == silver
    assert gold_rows(spark, layout) == gold
    assert layout.readings.read(spark).count() == 5


def random_envelopes(seed, count=60):
    pick = random.Random(seed)
    out = []
    for _ in range(count):
        out.append(
            [
                reading(pick.randrange(4), m, MINUTE + pick.randrange(40) * 997_000, round(pick.uniform(0, 50), 2))
                for m in pick.sample(["Wind_speed", "Humidity", "Rotor_rpm", "Error_code"], 3)
            ]
        )
    return out


@pytest.mark.parametrize("parts,grain", [(1, "hour"), (3, "quarter"), (2, "5 minutes")])
def test_stream_equals_batch(spark, tmp_path, parts, grain):
    layout, landing = Layout(root=str(tmp_path / "store"), grain=grain), tmp_path / "landing"
    envelopes = random_envelopes(parts)
    for i in range(parts):
        drop(landing, f"{i}.json", *envelopes[i::parts])
        run(spark, layout, landing, start_silver, start_gold)
    numeric = ("Wind_speed", "Humidity", "Rotor_rpm", "Error_code")
    names = ["device_id", "event_time", *layout.catalog.names]
    batch = silver_of(layout.bronze.read(spark), layout)
    assert silver_rows(spark, layout) == sorted(map(tuple, batch.select(names).collect()))
    stats = gold_of(batch, layout)
    for s in STATISTICS:
        twin = stats.select("device_id", F.unix_millis("window_start"), *[f"{n}_{s}" for n in numeric])
        expected = sorted(map(tuple, twin.collect()), key=repr)
        found = sorted(gold_rows(spark, layout, s, numeric), key=repr)
        assert [r[:2] for r in found] == [r[:2] for r in expected]
        for a, b in zip(found, expected):
            assert [x is None for x in a] == [x is None for x in b]
            assert [x for x in a if x is not None] == pytest.approx([x for x in b if x is not None])


def test_rebuild_equals_the_stream_and_the_stream_goes_on(spark, layout, tmp_path):
    landing = tmp_path / "landing"
    drop(landing, "a.json", *random_envelopes(7, 20))
    run(spark, layout, landing, start_silver, start_gold)
    silver, gold = silver_rows(spark, layout), gold_rows(spark, layout)
    rebuild(spark, layout)
    assert silver_rows(spark, layout) == silver
    assert gold_rows(spark, layout) == gold
    drop(landing, "b.json", [reading(device=9, value=2)])
    run(spark, layout, landing, start_silver, start_gold)
    assert len(silver_rows(spark, layout)) == len(silver) + 1
    assert len(gold_rows(spark, layout)) == len(gold) + 1


def test_backfill_adds_what_is_missing_and_can_be_repeated(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading(value=1)])
    run(spark, layout, landing, start_silver, start_gold)
    drop(landing / "old", "b.json", [reading(at=MINUTE + 1, value=3)])
    for _ in range(2):
        backfill(spark, layout, str(landing), load=1)
        assert gold_rows(spark, layout) == [(1, MINUTE, 2.0)]
        assert all_bronze(spark, layout).count() == 2
    backfill(spark, layout, str(landing), load=2)
    assert all_bronze(spark, layout).count() == 2
    rebuild(spark, layout)
    assert gold_rows(spark, layout) == [(1, MINUTE, 2.0)]


@pytest.mark.parametrize("layers", [[start_silver, start_gold], [start_silver_and_gold], [start_gold_partials]])
def test_a_late_row_rebuilds_its_span_and_shard_only(spark, tmp_path, layers):
    store, landing = tmp_path / "store", tmp_path / "landing"
    layout = Layout(root=str(store), shards=8)
    drop(landing, "a.json", [reading(device=d, at=MINUTE + h * 3_600_000, value=d) for d in range(40) for h in range(2)])
    run(spark, layout, landing, *layers)
    tables_ = ["silver", "metrics_avg", "metrics_min", "metrics_max", "metrics_stddev"][layers == [start_gold_partials] :]

    def files(name):
        return {str(p.relative_to(store / name)) for p in (store / name).rglob("*.parquet")}

    before = {t: files(t) for t in tables_}
    assert all(len({f.split("/")[0] for f in found}) == 16 for found in before.values())
    drop(landing, "b.json", [reading(device=7, at=MINUTE + 1, value=9)])
    run(spark, layout, landing, *layers)
    for table in tables_:
        changed = {f.split("/")[0] for f in files(table) ^ before[table]}
        assert len(changed) == 1 and changed.pop().split("=")[1].startswith("2024-01-01T00_")
    gold = layout.gold("avg").read(spark)
    assert gold.count() == 80
    found = of_device(gold, 7, shards=8, bucket="window_bucket")
    assert [r["Wind_speed"] for r in found.orderBy("window_start").collect()] == [8.0, 7.0]
    assert {r[0] for r in gold.select("window_bucket").distinct().collect()} == {f"2024-01-01T0{h}_000{s}" for h in (0, 1) for s in range(8)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EndsWith" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_many_buckets(spark, folder_layout, tmp_path, monkeypatch):
    layout, landing = folder_layout, tmp_path / "landing"
    monkeypatch.setattr(tables, "NAMES_AT_ONCE", 3)
    hours = [reading(at=MINUTE + h * 3_600_000, value=h) for h in range(8)]
    drop(landing, "a.json", hours)
    run(spark, layout, landing, start_silver, start_gold)
    drop(landing, "b.json", [reading(at=MINUTE + h * 3_600_000 + 1, value=h + 2) for h in range(6)])
    run(spark, layout, landing, start_silver, start_gold)
    expected = [h + 1.0 if h < 6 else float(h) for h in range(8)]
    assert [r[2] for r in gold_rows(spark, layout)] == expected


def test_impossible_times_do_not_stop_the_batch(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading(at=10**18), reading(at=None), reading(value=4)])
    run(spark, layout, landing, start_silver, start_gold)
    assert gold_rows(spark, layout) == [(1, MINUTE, 4.0)]


def test_a_bounded_batch_takes_a_part_of_the_backlog(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    for i in range(3):
        drop(landing, f"{i}.json", [reading(at=MINUTE + i, value=i)])
    start_bronze(spark, layout, str(landing), maxFilesPerTrigger=1).awaitTermination()
    start_silver(spark, layout, maxBytesPerTrigger=1).awaitTermination()
    assert layout.readings.read(spark).select("bid").distinct().count() == 3
    start_gold(spark, layout, maxFilesPerTrigger=2).awaitTermination()
    assert gold_rows(spark, layout) == [(1, MINUTE, 1.0)]


def test_whole_second_records(spark, tmp_path):
    layout, landing = Layout(root=str(tmp_path / "store"), whole_seconds=True), tmp_path / "landing"
    drop(landing, "a.json", [reading(at=MINUTE + 809, value=2)])
    run(spark, layout, landing, start_silver_and_gold)
    drop(landing, "b.json", [reading(at=MINUTE + 509, value=1), reading(at=MINUTE + 1_000, value=4)])
    run(spark, layout, landing, start_silver_and_gold)
    rows = layout.silver.read(spark).select(F.unix_millis("event_time"), "Wind_speed").orderBy("event_time")
    assert [tuple(r) for r in rows.collect()] == [(MINUTE, 1.0), (MINUTE + 1_000, 4.0)]
    assert gold_rows(spark, layout) == [(1, MINUTE, 2.5)]


def test_layers_from_sql(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading(device=13, value=1), reading(device=2, value=3)])
    run(spark, layout, landing, start_silver_and_gold)
    assert register_views(spark, layout)[:2] == ["bronze", "silver"]
    assert spark.sql("SELECT * FROM silver WHERE device_id = '13'").count() == 1
    rows = spark.sql("SELECT * FROM metrics_avg ORDER BY device_id").collect()
    assert [(r["device_id"], r["Wind_speed"]) for r in rows] == [(2, 3.0), (13, 1.0)]


def test_old_and_nested_files_are_read(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "new.json", [reading(value=1)])
    drop(landing / "deep", "old.json", [reading(at=MINUTE + 1, value=3)])
    os.utime(landing / "deep" / "old.json", (1_600_000_000, 1_600_000_000))
    start_bronze(spark, layout, str(landing), recursive=True).awaitTermination()
    assert layout.bronze.read(spark).count() == 2
    drop(landing, "older.json", [reading(at=MINUTE + 2, value=5)])
    os.utime(landing / "older.json", (1_500_000_000, 1_500_000_000))
    start_bronze(spark, layout, str(landing), recursive=True).awaitTermination()
    assert layout.bronze.read(spark).count() == 3


def test_backfill_and_rebuild_keep_partials_right(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading(value=1), reading(at=MINUTE + 60_000, value=5)])
    run(spark, layout, landing, start_gold_partials)
    drop(tmp_path / "more", "b[1].json", [reading(at=MINUTE + 1, value=3)])
    for _ in range(2):
        backfill(spark, layout, str(tmp_path / "more"), load=1)
        assert gold_rows(spark, layout) == [(1, MINUTE, 2.0), (1, MINUTE + 60_000, 5.0)]
    rebuild(spark, layout)
    assert gold_rows(spark, layout) == [(1, MINUTE, 2.0), (1, MINUTE + 60_000, 5.0)]
    drop(landing, "c.json", [reading(at=MINUTE + 2, value=8)])
    run(spark, layout, landing, start_gold_partials)
    assert gold_rows(spark, layout) == [(1, MINUTE, 4.0), (1, MINUTE + 60_000, 5.0)]
    assert layer_status(spark, layout).where("layer = 'Bronze'").first()[1] == 3
    register_views(spark, layout)
    assert spark.table("bronze").count() == 3


def test_native_state_ignores_nulls_and_refuses_a_backfill(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading(value=None), reading(value=10)])
    start_bronze(spark, layout, str(landing)).awaitTermination()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    start_gold_native(spark, layout, state_partitions=2).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert gold_rows(spark, layout) == [(1, MINUTE, 10.0)]
    with pytest.raises(ValueError):
        backfill(spark, layout, str(landing), load=1)


def test_the_combined_stream_announces_nothing(spark, folder_layout, tmp_path):
    layout, landing = folder_layout, tmp_path / "landing"
    drop(landing, "a.json", [reading()])
    run(spark, layout, landing, start_silver_and_gold)
    assert not layout.changes.exists(spark)


def test_compaction_changes_no_result(spark, folder_layout, tmp_path, monkeypatch):
    """Several rounds, one of them cut off before it deletes, with batches and late rows between them."""
    layout, landing = folder_layout, tmp_path / "landing"
    values = []

    def add(value):
        values.append(value)
        drop(landing, f"{len(values)}.json", [reading(at=MINUTE + len(values), value=value)])
        run(spark, layout, landing, start_silver, start_gold_partials)
        average = sum(values) / len(values)
        assert gold_rows(spark, layout) == [(1, MINUTE, pytest.approx(average))]
        assert len(silver_rows(spark, layout)) == len(values)

    def batches(dataset):
        return [sorted(b) for b in dataset.batch_folders(spark).values()]

    for value in (1, 2, 30):
        add(value)
    folded = compaction.compact(spark, layout, least=2)
    assert (folded["readings"], folded["window_partials"]) == (1, 1)
    folded = tables.FOLDED
    assert batches(layout.readings) == batches(layout.partials) == [[folded - 1, 2]]
    assert layout.partials.read(spark).where(f"bid = {folded - 1}").count() == 1
    assert not any(compaction.compact(spark, layout, least=2).values())
    add(7)
    add(11)
    with monkeypatch.context() as m:
        m.setattr(compaction, "delete_folder", lambda spark, path: None)
        compaction.compact(spark, layout, least=2)
    assert batches(layout.partials) == [[folded - 3, folded - 1, 2, 3, 4]]
    # A whole read passes over what is not deleted yet, as a read of some partitions does.
    assert layout.readings.read(spark).count() == len(values)
    assert sum(r[0] for r in layout.partials.read(spark).select("Wind_speed_n").collect()) == len(values)
    add(13)
    compaction.compact(spark, layout, least=9)
    assert batches(layout.partials) == [[folded - 3, 4, 5]]
    add(17)
    rebuild(spark, layout)
    assert gold_rows(spark, layout) == [(1, MINUTE, pytest.approx(sum(values) / len(values)))]
    assert batches(layout.partials) == [[-1]]
