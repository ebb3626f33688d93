"""Time conversions. None of them depends on the time zone of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds in one storage partition, by name.
GRAINS = {"quarter": 900, "hour": 3_600, "day": 86_400}

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}

# The years 1 to 9999, the range of a timestamp, in epoch milliseconds.
FIRST_MILLI = -62_135_596_800_000
LAST_MILLI = 253_402_300_799_999

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def interval_seconds(text: str) -> int:
    """Length of an interval such as ``1 minute`` or ``30 seconds``."""
    count, unit = text.split()
    return int(count) * UNIT_SECONDS[unit.rstrip("s")]


def grain_seconds(grain: str) -> int:
    """Seconds in one storage partition: a name of GRAINS, or whole minutes that divide an hour, such
    as ``5 minutes``."""
    seconds = GRAINS[grain] if grain in GRAINS else interval_seconds(grain)
    if seconds not in GRAINS.values() and (seconds <= 0 or seconds % 60 or 3_600 % seconds):
        raise ValueError(f"{grain} neither has a name nor divides an hour into whole minutes")
    return seconds


def instant(millis: str | Column) -> Column:
    """Epoch milliseconds to a timestamp, keeping the milliseconds."""
    return F.timestamp_millis(millis)


def whole_second_instant(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    return F.timestamp_seconds(F.floor(millis / 1000))


def in_range(millis: Column) -> Column:
    """Whether epoch milliseconds can be a timestamp at all; the conversion raises otherwise."""
    return millis.between(FIRST_MILLI, LAST_MILLI)


def bucket_of_millis(millis: Column, grain: str) -> Column:
    """Name of the storage partition of an instant, from its start in UTC: ``2024-01-31``,
    ``2024-01-31T23`` or, below an hour, ``2024-01-31T23-45``. Names sort by time."""
    seconds = grain_seconds(grain)

    def part(span: int, count: int, step: int = 1) -> Column:
        within = F.pmod(F.floor(millis / span), F.lit(count)) * step
        return F.lpad(within.cast("string"), 2, "0")

    day = F.date_from_unix_date(F.floor(millis / 86_400_000).cast("int")).cast("string")
    if seconds == 86_400:
        return day
    hour = F.concat_ws("T", day, part(3_600_000, 24))
    if seconds == 3_600:
        return hour
    return F.concat_ws("-", hour, part(seconds * 1_000, 3_600 // seconds, seconds // 60))


def device_shard(device: str | Column, shards: int) -> Column:
    """The number of a device's shard, as it stands in the names of partitions."""
    device = F.col(device) if isinstance(device, str) else device
    return F.lpad(F.pmod(F.xxhash64(device.cast("bigint")), F.lit(shards)).cast("string"), 4, "0")


def in_shards(bucket: Column, device: str, shards: int) -> Column:
    """The storage partition of an instant and a device: ``2024-01-31T23_0007``. One shard needs no name."""
    return bucket if shards == 1 else F.concat_ws("_", bucket, device_shard(device, shards))


def bucket_of_instant(timestamp: Column, grain: str) -> Column:
    return bucket_of_millis(F.unix_millis(timestamp), grain)


def millis_of_ntz(column: str) -> Column:
    """UTC wall-clock timestamp without zone to epoch milliseconds, truncated."""
    wall = F.col(column)
    return (
        F.unix_date(wall.cast("date")).cast("bigint") * 86_400_000
        + F.hour(wall) * 3_600_000
        + F.minute(wall) * 60_000
        + F.floor(F.expr(f"extract(SECOND FROM `{column}`)") * 1000).cast("bigint")
    )


def ntz(timestamp: Column) -> Column:
    """A timestamp as UTC wall-clock time without zone."""
    return F.expr(EPOCH_NTZ) + F.unix_micros(timestamp) * F.expr("interval '0.000001' second")
