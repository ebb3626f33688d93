"""The same results in ANSI SQL over the same tables."""

from __future__ import annotations

from millrace.catalog import STATISTICS
from millrace.plans.standins import ENVELOPE_IDS, EVENT_METRICS

SQL_AGGREGATES = {"avg": "avg", "min": "min", "max": "max", "stddev": "stddev_samp"}
NAMES = EVENT_METRICS.names
MILLIS = "epoch_us(ts) // 1000"


def firsts(names=NAMES) -> str:
    """The earliest value of each event type."""
    return ", ".join(f"arg_min(value, event_id) FILTER (WHERE event_type = '{n}') AS \"{n}\"" for n in names)


def statistics(names=NAMES) -> str:
    return ", ".join(f'round({SQL_AGGREGATES[s]}("{n}"), 6) AS "{n}_{s}"' for s in STATISTICS for n in names)


HOURLY = f"""SELECT user_id AS device_id, date_trunc('hour', ts) AS event_time, {firsts()}
FROM events GROUP BY user_id, date_trunc('hour', ts)"""

EXACT = f"""SELECT user_id AS device_id, date_trunc('millisecond', ts) AS event_time, {firsts()}
FROM events GROUP BY user_id, date_trunc('millisecond', ts)"""


def windows(records: str, unit: str, columns: str) -> str:
    start = f"CAST(date_trunc('{unit}', event_time) AS TIMESTAMP)"
    return f"""SELECT device_id, {start} AS window_start, {start} + INTERVAL 1 {unit} AS window_end, {columns}
FROM ({records}) GROUP BY device_id, {start}"""


def one(statistic: str) -> str:
    return ", ".join(f'round({SQL_AGGREGATES[statistic]}("{n}"), 6) AS "{n}"' for n in NAMES)


def stacked(records: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{s}' AS statistic FROM ({windows(records, 'hour', one(s))})" for s in STATISTICS
    )


READINGS = f'SELECT user_id AS device_id, event_type AS metric, {MILLIS} AS "timestampUtc", value'

EVENT_COLUMNS = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}

RATE = f"""SELECT *, round(silver_records / bronze_records * 100, 1) AS processing_rate,
bronze_records - silver_records AS records_pending,
round(silver_readings / bronze_readings * 100, 1) AS reading_rate,
bronze_readings - silver_readings AS readings_pending
FROM (SELECT (SELECT count(DISTINCT event_id // {ENVELOPE_IDS}) FROM events) AS bronze_records,
(SELECT count(*) FROM ({HOURLY})) AS silver_records,
(SELECT count(*) FROM events) AS bronze_readings, (SELECT count(*) FROM events) AS silver_readings)"""

ORACLES: dict[str, str] = {
    "medallion_batch": windows(EXACT, "hour", statistics()),
    "json_scalar_extract": "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events",
    "json_array_explode": f"{READINGS} FROM events",
    "schema_infer_json": """SELECT DISTINCT unnest(json_keys(props)) AS column_name, 'string' AS data_type
FROM events""",
    "epoch_ms_to_timestamp": """SELECT event_id, date_trunc('millisecond', ts) AS event_time,
date_trunc('second', ts) AS whole_second FROM events""",
    "typed_casts": """SELECT event_id,
try_cast(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS as_double,
CAST(trunc(try_cast(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE))
AS INTEGER) AS as_int,
try_cast(props->>'k' AS BOOLEAN) AS as_boolean, event_type AS as_string FROM events""",
    "pivot_first": HOURLY,
    "silver_whole_seconds": f"""SELECT device_id, second AS event_time, {', '.join(f'"{n}"' for n in NAMES)} FROM (
SELECT *, date_trunc('second', event_time) AS second,
row_number() OVER (PARTITION BY device_id, date_trunc('second', event_time) ORDER BY event_time) AS place
FROM ({EXACT})) WHERE place = 1""",
    "dedup_keys": """SELECT user_id, day, event_id, event_type, value FROM (
SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id) AS place
FROM events) WHERE place = 1""",
    "tumbling_stats": windows(
        "SELECT user_id AS device_id, ts AS event_time, value FROM events", "hour", statistics(["value"])
    ),
    **{f"gold_{s}": windows(HOURLY, "day", one(s)) for s in STATISTICS},
    "numeric_profile": f"SELECT device_id, {statistics()} FROM ({HOURLY}) GROUP BY device_id",
    "merge_partials": windows(
        "SELECT user_id AS device_id, ts AS event_time, value FROM events", "hour", statistics(["value"])
    ),
    "gold_ordered": windows(HOURLY, "day", one("avg")) + " ORDER BY device_id, window_start",
    "gold_upsert": windows(HOURLY, "day", one("avg")),
    "device_counts": f"SELECT device_id, count(*) AS info_count FROM ({HOURLY}) GROUP BY device_id",
    "device_filter": f"SELECT * FROM ({HOURLY}) WHERE device_id = 13",
    "schema_report": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM events"
        for i, (c, t) in enumerate(EVENT_COLUMNS.items(), 1)
    ),
    "reading_quality": f"""SELECT
(SELECT count(DISTINCT event_id // {ENVELOPE_IDS}) + count(*) FROM events)
+ (SELECT count(*) FROM documents) AS envelopes,
(SELECT count(*) FROM documents) AS envelopes_without_readings,
(SELECT 2 * count(*) FROM events) AS readings,
(SELECT count(*) FROM events) AS without_device,
(SELECT count(*) FROM events) AS without_metric,
(SELECT count(*) FROM events) AS without_time,
(SELECT count(*) FROM events) AS valid_readings""",
    "layer_status": f"""SELECT 'Bronze' AS layer, count(DISTINCT event_id // {ENVELOPE_IDS}) AS total_records,
CAST(NULL AS BIGINT) AS unique_devices, max(ts) AS latest_timestamp, 'OK' AS status FROM events
UNION ALL SELECT 'Silver', count(*), count(DISTINCT device_id), max(event_time), 'OK' FROM ({HOURLY})
UNION ALL SELECT 'Missing', 0, NULL, NULL, 'Error: [TABLE_OR_VIEW_NOT_FOUND] The table or view `absen'""",
    "processing_rate": RATE,
    "stored_rate": RATE,
    "gold_status": " UNION ALL ".join(
        f"""SELECT '{s.upper()}' AS metric, count(*) AS total_records, count(DISTINCT device_id) AS unique_devices,
count(DISTINCT window_start) AS time_windows, min(window_start) AS earliest_window,
max(window_start) AS latest_window, 'active' AS status FROM ({windows(HOURLY, "day", one(s))})"""
        for s in STATISTICS
    ),
    "incremental_file_anti": f"""{READINGS}, true AS has_ingestion_time FROM events
WHERE event_type NOT IN ('view', 'click')""",
    "bronze_rescued": r"""SELECT CASE WHEN event_type <> 'error' THEN event_id END AS sequence,
CAST(CASE WHEN event_type <> 'error' THEN json_object('props', CAST(props AS JSON))
ELSE json_object('props', CAST(props AS JSON), 'sequence', 'x' || event_id) END AS VARCHAR) AS rescued FROM events
UNION ALL SELECT NULL, line FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents)
WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')""",
    "rescued_by_name": """SELECT 'props' AS name, 'OBJECT' AS type, count(*) AS n,
CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total FROM events
UNION ALL SELECT 'sequence', 'STRING', count(*), NULL FROM events WHERE event_type = 'error'""",
    "schema_growth": """SELECT event_id AS sequence, CASE WHEN event_id % 2 = 1 THEN event_type END AS site,
CASE WHEN event_id % 2 = 1 THEN CAST(json(props) AS VARCHAR) END AS details, true AS complete FROM events""",
    "backfill_recompute": stacked(EXACT),
    "backfill_partials": stacked(EXACT),
    "bronze_append_stream": f"{READINGS}, true AS has_ingestion_time FROM events",
    "bronze_two_runs": f"{READINGS}, true AS has_ingestion_time FROM events",
    "silver_stream": HOURLY,
    "silver_rebuild": HOURLY,
    "window_recompute_stream": stacked(EXACT),
    "window_sharded_stream": stacked(EXACT),
    "window_partials_stream": stacked(EXACT),
    "window_native_stream": stacked(EXACT),
    "native_open_windows": """SELECT DISTINCT user_id AS device_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start,
CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end, watermark FROM events,
(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 30 SECOND AS watermark FROM events)
WHERE CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR > watermark""",
    "stored_status": f"""SELECT 'Silver' AS metric, count(*) AS total_records, count(DISTINCT device_id) AS unique_devices,
CAST(NULL AS BIGINT) AS time_windows, max(event_time) AS latest FROM ({EXACT}) UNION ALL """
    + " UNION ALL ".join(
        f"""SELECT '{s.upper()}', count(*), count(DISTINCT device_id), count(DISTINCT window_start), max(window_start)
FROM ({windows(EXACT, "hour", one(s))})"""
        for s in STATISTICS
    ),
}
