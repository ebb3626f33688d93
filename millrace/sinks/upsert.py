"""Upsert into a partitioned dataset without a table format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sinks.fanout import computed_once
from millrace.sources.tables import Dataset, Partitions


# Source rows whose keys are sent to every executor, so that the target is not shuffled to be matched.
BROADCAST_ROWS = 500_000


def merged(
    target: DataFrame, source: DataFrame, keys: list[str], few: bool = False, matched: DataFrame | None = None
) -> DataFrame:
    """Source rows, and the target rows whose key the source does not have.

    A matched row is replaced whole. Keys are compared null-safely: a null key matches a null key.
    ``source`` must have one row per key. If it has ``few`` rows, the target stays where it is. ``matched`` are the rows
    of it that the target can have keys of; else all are.
    """
    s = (source if matched is None else matched).select(*keys)
    t, s = target.alias("t"), (F.broadcast(s) if few else s).alias("s")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    kept = t.join(s, on=_all(same), how="left_anti")
    return kept.unionByName(source.select(target.columns))


def _all(conditions):
    condition = conditions[0]
    for c in conditions[1:]:
        condition = condition & c
    return condition


def upsert(
    dataset: Dataset,
    source: DataFrame,
    keys: list[str],
    touched: Partitions | None = None,
    fixed_partition: bool = False,
) -> None:
    """Merge ``source`` into ``dataset``, rewriting only the partitions it touches.

    Creates the dataset from the first source. Writing the same source twice changes nothing. The
    source is computed once. A key that the source has twice is an error, as is a key that the
    dataset holds in another partition; ``fixed_partition`` says that the partition follows from the
    key, which saves looking for the latter.
    """
    spark = source.sparkSession
    by = dataset.partition_by[0]
    with computed_once(source) as source:
        rows = checked_rows(source, keys)
        touched = touched or Partitions.of(source, by)
        if not fixed_partition and dataset.exists(spark):
            held, new = dataset.read(spark).select(*keys, by).alias("t"), source.select(*keys, by).alias("s")
            same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
            moved = held.join(new, _all(same) & ~F.col(f"t.{by}").eqNullSafe(F.col(f"s.{by}")), "left_semi").limit(1).collect()
            if moved:
                raise ValueError(f"a key is in another partition: {moved[0].asDict()}")
        write_merged(dataset, source, keys, touched, rows)


def checked_rows(source: DataFrame, keys: list[str]) -> int:
    """How many rows there are. A key that comes twice is an error."""
    per_key = source.groupBy(*keys).count()
    most, rows = per_key.agg(F.max("count"), F.sum("count")).first()
    if most and most > 1:
        raise ValueError(f"a key comes more than once: {per_key.where('count > 1').first().asDict()}")
    return rows or 0


def write_merged(dataset: Dataset, source: DataFrame, keys: list[str], touched: Partitions, rows: int) -> None:
    """The write of ``upsert``, for a source that is kept and checked, and whose keys are in no other partition.

    Only source rows of partitions that the dataset has already are matched.
    """
    target = dataset.read_partitions(source.sparkSession, touched)
    source = source.select(target.columns)
    known = source.where(F.col(dataset.partition_by[0]).isin(dataset.held_values(source.sparkSession, touched)))
    dataset.overwrite_partitions(merged(target, source, keys, few=rows <= BROADCAST_ROWS, matched=known))
