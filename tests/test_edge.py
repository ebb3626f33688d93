"""What becomes of landing texts: columns, rescued text, columns that grow, and the ledger of files."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import Layout
from millrace.operators.edge import bronze_rows, rescued_fields, rescued_texts
from millrace.plans import batch as plans
from millrace.plans.batch import backfill, rebuild
from millrace.sources import backfill as files
from millrace.sources.backfill import all_bronze, held_files, ledger_bucket, pending_files
from millrace.sources.landing import stored_schema, widened
from millrace.streaming.bronze import grown, start_bronze, store_landing
from millrace.streaming.gold import start_gold, start_gold_partials
from millrace.streaming.silver import start_silver

SCHEMA = T.StructType().add("values", "string").add("sequence", "long").add("tags", T.ArrayType(T.IntegerType()))

# Text, and the rows that come of it: values, sequence, tags, rescued.
TEXTS = [
    ('{"values": [1, {"a": 1.0}], "sequence": 7}', [('[1,{"a":1.0}]', 7, None, None)]),
    ("{}", [(None, None, None, None)]),
    ("", []),
    (" \t ", []),
    ("not json", [(None, None, None, "not json")]),
    ('{"values": [1', [(None, None, None, '{"values": [1')]),
    ("5", [(None, None, None, "5")]),
    ("[]", [(None, None, None, "[]")]),
    ('[{"sequence": 1}, 5]', [(None, None, None, '[{"sequence": 1}, 5]')]),
    ('[{"sequence": 1}, {"x": 2}]', [(None, 1, None, None), (None, None, None, '{"x":2}')]),
    # Something behind the object, a name that comes twice.
    ('{"sequence": 1} x', [(None, None, None, '{"sequence": 1} x')]),
    ('{"sequence": 1}{"sequence": 2}', [(None, None, None, '{"sequence": 1}{"sequence": 2}')]),
    ('{"sequence": 1, "sequence": 2}', [(None, 1, None, '{"sequence": 1, "sequence": 2}')]),
    # Fields that are not declared, with their types; values that do not fit.
    ('{"values": null, "site": 1, "n": null, "o": {"p": [true]}}', [(None, None, None, '{"n":null,"o":{"p":[true]},"site":1}')]),
    ('{"sequence": "x17", "tags": [1, 2]}', [(None, None, [1, 2], '{"sequence":"x17"}')]),
    ('{"sequence": "17", "tags": "none"}', [(None, 17, None, '{"tags":"none"}')]),
    ('{"Values": 1}', [(None, None, None, '{"Values":1}')]),
    ('{"": 1, "a.b": 2, "é😀`": 3}', [(None, None, None, '{"":1,"a.b":2,"é😀`":3}')]),
    ('\t[ {"sequence": 1} ]', [(None, 1, None, None)]),
    ("null", [(None, None, None, "null")]),
]


def texts(spark, lines, file="f"):
    frame = spark.createDataFrame([(t,) for t in lines], "value string")
    return frame.withColumns({"source_file": F.lit(file), "ingestion_time": F.current_timestamp()})


@pytest.mark.parametrize("text, expected", TEXTS, ids=range(len(TEXTS)))
def test_every_text_ends_up_somewhere(spark, text, expected):
    rows = bronze_rows(texts(spark, [text]), SCHEMA).collect()
    found = [tuple(r[c] for c in ("values", "sequence", "tags", "rescued")) for r in rows]
    assert found == expected
    assert all(r["source_file"] == "f" and r["ingestion_time"] for r in rows)


def test_a_null_text_and_an_empty_table_give_no_row(spark):
    assert bronze_rows(texts(spark, ["x"]).withColumn("value", F.lit(None).cast("string")), SCHEMA).count() == 0
    assert bronze_rows(texts(spark, ["x"]).where("false"), SCHEMA).count() == 0


def test_whole_files_of_several_lines(spark):
    pretty = json.dumps([{"sequence": 1, "site": "a"}, {"sequence": 2}], indent=2)
    rows = bronze_rows(texts(spark, [pretty, "{\n broken"]), SCHEMA).collect()
    assert [(r["sequence"], r["rescued"]) for r in rows] == [(1, '{"site":"a"}'), (2, None), (None, "{\n broken")]


def test_rescued_fields_have_their_types(spark):
    lines = ['{"site": 1, "deep": {"k": "v"}, "price": 1.25}', '{"site": "a"}', "[1, 2]", "broken {", "{}"]
    rows = bronze_rows(texts(spark, lines), SCHEMA)
    found = sorted((r["name"], r["type"], r["value"]) for r in rescued_fields(rows).collect())
    assert found == [
        ("deep", "OBJECT<k: STRING>", '{"k":"v"}'),
        ("price", "DECIMAL(3,2)", "1.25"),
        ("site", "BIGINT", "1"),
        ("site", "STRING", '"a"'),
    ]
    assert sorted(r["text"] for r in rescued_texts(rows).collect()) == ["[1, 2]", "broken {"]


def test_one_parse_where_nothing_is_left_over(spark):
    """The text is parsed once for all columns; the plan is narrow."""
    plan = bronze_rows(texts(spark, ["{}"]), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(MapType") == 1
    assert "Exchange" not in bronze_rows(texts(spark, ["{}"]), SCHEMA)._jdf.queryExecution().executedPlan().toString()


def drop(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


@pytest.fixture(params=["folder", "table"])
def layout(request, spark, tmp_path):
    database = None
    if request.param == "table":
        database = "e_" + tmp_path.name.replace("-", "_").replace("[", "_").replace("]", "_")
        spark.sql(f"CREATE DATABASE {database}")
    return Layout(root=str(tmp_path / "store"), database=database)


def rows_of(spark, layout, *columns):
    frame = grown(spark, layout).bronze.read(spark).select(*columns)
    return sorted(map(tuple, frame.collect()), key=str)


def test_columns_grow_in_the_stream(spark, layout, tmp_path):
    landing = tmp_path / "landing"
    drop(landing, "a.json", {"values": "v1"})
    start_bronze(spark, layout, str(landing)).awaitTermination()
    assert grown(spark, layout) == layout
    drop(landing, "b.json", {"values": "v2", "site": 5, "Values": 1, "bid": 9, "a.b": 2}, "broken")
    start_bronze(spark, layout, str(landing)).awaitTermination()
    assert grown(spark, layout).landing_schema.names == ["values", "site"]
    drop(landing, "c.json", {"values": "v3", "site": [1], "SITE": 2, "zone": "z"})
    drop(landing, "d.json", {"values": "v4"})
    start_bronze(spark, layout, str(landing), maxFilesPerTrigger=1).awaitTermination()
    assert rows_of(spark, layout, "values", "site", "zone", "rescued") == sorted(
        [
            ("v1", None, None, None),
            ("v2", "5", None, '{"Values":1,"a.b":2,"bid":9}'),
            (None, None, None, "broken"),
            ("v3", "[1]", "z", '{"SITE":2}'),
            ("v4", None, None, None),
        ],
        key=str,
    )
    # Those that know the first columns only go on.
    assert layout.bronze.read(spark).count() == 5
    assert stored_schema(spark, layout.schema_store)[0] == 2
    start_silver(spark, layout).awaitTermination()


def test_names_beyond_the_bound_stay_in_rescued(spark, tmp_path):
    assert widened(SCHEMA, ["b", "a", "TAGS", "c"], max_columns=5).names == ["values", "sequence", "tags", "a", "b"]


def test_a_batch_that_is_run_again_keeps_its_files(spark, tmp_path):
    layout = Layout(root=str(tmp_path / "store"))
    batch = texts(spark, ['{"values": "v", "site": 1}', "broken"], "file:/x/a.json")
    store_landing(layout, batch, 0)
    before = sorted(p.name for p in (tmp_path / "store/bronze").rglob("*.parquet"))
    store_landing(layout, batch, 0)
    assert sorted(p.name for p in (tmp_path / "store/bronze").rglob("*.parquet")) == before
    assert rows_of(spark, layout, "values", "site", "rescued") == [("v", "1", None), (None, None, "broken")]
    assert [r["source_file"] for r in layout.ledger.read(spark).collect()] == ["file:/x/a.json"]


def test_the_ledger_is_read_in_part_and_bronze_not_at_all(spark, tmp_path):
    layout, landing = Layout(root=str(tmp_path / "store")), tmp_path / "landing"
    for i in range(40):
        drop(landing, f"{i}.json", {"values": f"v{i}"})
    start_bronze(spark, layout, str(landing)).awaitTermination()
    drop(tmp_path / "other", "7.json", {"values": "w"})
    found = files.files_in(spark, str(tmp_path / "other"))
    held = held_files(spark, layout, found)
    buckets = {r[0] for r in found.select(ledger_bucket("source_file")).collect()}
    read = held.inputFiles()
    assert read and all(f"/bucket={b}/" in p for b in buckets for p in read)
    assert len(read) < len(layout.ledger.read(spark).inputFiles()) / 2
    plan = pending_files(found, held)
    assert not any("/store/bronze/" in p for p in plan.inputFiles())
    assert plan.count() == 1
    assert pending_files(found, held, by="name").count() == 0


@pytest.mark.parametrize("layers", [[start_silver, start_gold], [start_gold_partials]])
def test_a_load_goes_on_where_it_failed(spark, tmp_path, monkeypatch, layers):
    layout, landing = Layout(root=str(tmp_path / "store")), tmp_path / "landing"
    reading = lambda at, v: {"values": [{"device_id": 1, "metric": "Wind_speed", "timestampUtc": at, "value": v}]}
    drop(landing, "s.json", reading(0, 1))
    start_bronze(spark, layout, str(landing)).awaitTermination()
    for start in layers:
        start(spark, layout).awaitTermination()
    more = tmp_path / "more"
    for i in range(5):
        drop(more, f"{i}.json", reading(1_000 * (i + 1), i + 2), {"site": i})

    calls = []

    def fails(layout, rows, number):
        calls.append(number)
        if len(calls) == 2:
            raise RuntimeError("lost")
        files.record_files(layout, rows, number)

    monkeypatch.setattr(plans, "record_files", fails)
    with pytest.raises(RuntimeError):
        backfill(spark, layout, str(more), load=1, files_at_once=2)
    # A file that comes meanwhile moves the bounds of the parts.
    drop(more, "00.json", reading(60_000, 50))
    assert backfill(spark, layout, str(more), load=1, files_at_once=2) == 3
    assert backfill(spark, layout, str(more), load=1, files_at_once=2) == 3
    gold = layout.gold("avg").read(spark).select(F.unix_millis("window_start"), "Wind_speed").orderBy("window_start")
    assert [tuple(r) for r in gold.collect()] == [(0, 3.5), (60_000, 50.0)]
    assert all_bronze(spark, layout).count() == 12
    assert all_bronze(spark, grown(spark, layout)).where("site IS NOT NULL").count() == 5
    rebuild(spark, layout)
    assert [tuple(r) for r in gold.collect()] == [(0, 3.5), (60_000, 50.0)]


def test_a_failed_batch_is_taken_again(spark, tmp_path, monkeypatch):
    """A batch that stops between its rows and the ledger is in both after the next start, once."""
    from millrace.streaming import bronze

    layout, landing = Layout(root=str(tmp_path / "store")), tmp_path / "landing"
    drop(landing, "a.json", {"values": "v"})
    with monkeypatch.context() as m:
        m.setattr(bronze, "record_files", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(StreamingQueryException):
            start_bronze(spark, layout, str(landing)).awaitTermination()
    start_bronze(spark, layout, str(landing)).awaitTermination()
    assert rows_of(spark, layout, "values") == [("v",)]
    assert layout.ledger.read(spark).count() == 1
