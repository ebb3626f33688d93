"""Tumbling-window statistics per device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.catalog import NOT_METRICS, NUMERIC_TYPES, STATISTICS, MetricCatalog, numeric_columns
from millrace.functions.casts import lenient_cast

AGGREGATES = {"avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp}

WINDOW_KEYS = ("device_id", "window_start", "window_end")


def statistics_of(columns: dict[str, Column]) -> list[Column]:
    """Every statistic of every column as ``<name>_<statistic>``, statistic by statistic."""
    return [AGGREGATES[s](c).alias(f"{n}_{s}") for s in STATISTICS for n, c in columns.items()]


def profile(frame: DataFrame, keys: list[str], exclude: frozenset[str] = NOT_METRICS) -> DataFrame:
    """All statistics of all numeric columns, chosen from the schema, in one pass."""
    names = [c for c in numeric_columns(frame.schema) if c not in exclude and c not in keys]
    return frame.groupBy(*keys).agg(*statistics_of({n: F.col(n) for n in names}))


def window_statistics(wide: DataFrame, window: str, names: list[str] | None = None) -> DataFrame:
    """Key, window, all averages, all minima, all maxima, all deviations, time of the build.

    Windows are half open and aligned to the epoch. Only the key, the time and the numeric columns
    are read; the aggregate combines on the map side, so a busy device does not load one task.
    """
    names = names if names is not None else numeric_columns(wide.schema)
    return _named(
        wide.groupBy("device_id", F.window("event_time", window)).agg(
            *statistics_of({n: F.col(n) for n in names})
        ),
        [f"{n}_{s}" for s in STATISTICS for n in names],
    )


def reading_window_statistics(readings: DataFrame, window: str, catalog: MetricCatalog) -> DataFrame:
    """The same statistics straight from valid long readings that hold no duplicates.

    One aggregation instead of two, and allowed on a stream, where a pivot is not.
    """
    columns = {
        m.name: F.when(F.col("metric") == m.name, lenient_cast(F.col("value"), m.data_type))
        for m in catalog.metrics
        if isinstance(m.data_type, NUMERIC_TYPES)
    }
    return _named(
        readings.groupBy("device_id", F.window("event_time", window)).agg(*statistics_of(columns)),
        [f"{n}_{s}" for s in STATISTICS for n in columns],
    )


def _named(grouped: DataFrame, columns: list[str]) -> DataFrame:
    return grouped.select(
        "device_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *columns,
        F.current_timestamp().alias("inserted_at"),
    )


def metrics_in(stats: DataFrame) -> list[str]:
    """The metrics that a frame has every statistic of, in its order."""
    have, names = set(stats.columns), [c.rpartition("_")[0] for c in stats.columns]
    return [n for n in dict.fromkeys(names) if all(f"{n}_{s}" in have for s in STATISTICS)]


def one_statistic(stats: DataFrame, statistic: str, metrics: list[str] | None = None) -> DataFrame:
    """Key, window and stamps, and one statistic of the metrics under their own names."""
    chosen = {n: f"{n}_{statistic}" for n in (metrics_in(stats) if metrics is None else metrics)}
    stamps = [c for c in ("inserted_at", "window_bucket") if c in stats.columns]
    return stats.select(*WINDOW_KEYS, *[F.col(c).alias(n) for n, c in chosen.items()], *stamps)


def window_partials(wide: DataFrame, window: str, names: list[str]) -> DataFrame:
    """Per metric: count, mean, sum of squared deviations, minimum and maximum.

    Partials of different batches combine into the exact statistics of all their rows.
    """
    moments = []
    for n in names:
        c = F.col(n)
        moments += [
            F.count(c).alias(f"{n}_n"),
            F.avg(c).alias(f"{n}_mean"),
            (F.var_pop(c) * F.count(c)).alias(f"{n}_m2"),
            F.min(c).alias(f"{n}_min"),
            F.max(c).alias(f"{n}_max"),
        ]
    grouped = wide.groupBy("device_id", F.window("event_time", window)).agg(*moments)
    return grouped.select(
        "device_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c not in ("device_id", "window")],
    )


def combine_partials(partials: DataFrame, names: list[str]) -> DataFrame:
    """One partial per window from all of its partials; they combine on as before.

    The deviations are taken from the joint mean, found first over the window's partials, which
    stays accurate where a difference of squares would cancel. Window function and aggregate share
    one shuffle; a window has one row per batch that touched it.
    """
    keys = Window.partitionBy(*WINDOW_KEYS)
    joint = {}
    for n in names:
        rows = F.sum(f"{n}_n").over(keys)
        joint[f"{n}_joint"] = F.sum(F.col(f"{n}_mean") * F.col(f"{n}_n")).over(keys) / F.when(rows > 0, rows)
    with_joint = partials.withColumns(joint)
    aggregates = []
    for n in names:
        shift = F.col(f"{n}_mean") - F.col(f"{n}_joint")
        aggregates += [
            F.sum(f"{n}_n").alias(f"{n}_n"),
            F.max(f"{n}_joint").alias(f"{n}_mean"),
            F.sum(F.col(f"{n}_m2") + F.col(f"{n}_n") * shift * shift).alias(f"{n}_m2"),
            F.min(f"{n}_min").alias(f"{n}_min"),
            F.max(f"{n}_max").alias(f"{n}_max"),
        ]
    return with_joint.groupBy(*WINDOW_KEYS).agg(*aggregates)


def merge_partials(partials: DataFrame, names: list[str]) -> DataFrame:
    """Combine the partials of each window into its statistics."""

    def column(n: str, s: str) -> Column:
        if s == "avg":
            return F.col(f"{n}_mean").alias(f"{n}_avg")
        if s != "stddev":
            return F.col(f"{n}_{s}")
        freedom = F.col(f"{n}_n") - 1
        return F.sqrt(F.col(f"{n}_m2") / F.when(freedom > 0, freedom)).alias(f"{n}_stddev")

    return combine_partials(partials, names).select(
        *WINDOW_KEYS,
        *[column(n, s) for s in STATISTICS for n in names],
        F.current_timestamp().alias("inserted_at"),
    )
