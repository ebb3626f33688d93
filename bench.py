"""Times the headline queries on one machine and prints one line of JSON.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of threads. Batch queries: median
of three runs into the ``noop`` sink after one warm-up. Streams: one run from files to result,
with start-up, staging of the input files and reading of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from millrace.operators.readings import explode_readings  # noqa: E402
from millrace.operators.windows import window_statistics  # noqa: E402
from millrace.plans.queries import QUERIES  # noqa: E402
from millrace.plans.standins import bronze_frame, table, telemetry  # noqa: E402
from millrace.session import build_session, scratch_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

STREAMS = [n for n in QUERIES if n.endswith("_stream") or n in ("bronze_two_runs", "silver_rebuild")]
FILES = ["gold_upsert", "incremental_file_anti"]
BATCH = [n for n in QUERIES if n not in STREAMS and n not in FILES]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def median(work) -> float:
    work()
    return round(statistics.median(timed(work) for _ in range(RUNS)), 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    # The shapes of the baseline: JSON text built beforehand, and one-minute windows.
    text = f"{scratch_folder(spark, 'bench')}/bronze"
    bronze_frame(telemetry(spark, SF_DIR)).write.parquet(text)
    times["parse_and_explode_prebuilt"] = median(
        lambda: run(explode_readings(spark.read.parquet(text), ("sequence",)))
    )
    events = table(spark, SF_DIR, "events").select(
        F.col("user_id").alias("device_id"), F.col("ts").alias("event_time"), "value"
    )
    times["one_minute_windows"] = median(lambda: run(window_statistics(events, "1 minute")))

    for name in BATCH:
        times[name] = median(lambda: run(QUERIES[name](spark, SF_DIR)))
    for name in FILES + STREAMS:
        times[name] = round(timed(lambda: run(QUERIES[name](spark, SF_DIR))), 3)

    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
