"""Figures of storage partitions, kept beside them, that add up over any span.

Rows and times add up by sums and extremes. Distinct numbers add up exactly as bitmaps: a bitmap stands for a range of
numbers and has a bit for each, so that the bits of several partitions are or-ed and counted. A report over a layer reads
the figures only, however large the layer is; when late rows rebuild a partition, its figures are rebuilt with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIGURES = "kind string, part bigint, bits binary, n bigint, earliest timestamp, latest timestamp"


def figures(rows: DataFrame, bucket: str, time: str, numbers: dict[str, Column]) -> DataFrame:
    """Per partition, kind of number and range of numbers: the bitmap of those that occur, rows, first and last time.

    One aggregate, combined on the map side. A number must be whole, and not null.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), n.cast("bigint").alias("number")) for k, n in numbers.items()])
    one = rows.select(bucket, F.col(time).alias("time"), F.inline(kinds))
    return one.groupBy(bucket, "kind", F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
        F.count("*").alias("n"),
        F.min("time").alias("earliest"),
        F.max("time").alias("latest"),
    )


def totals(stored: DataFrame, kinds: list[str]) -> DataFrame:
    """One row over all partitions: n, earliest, latest, and per kind how many different numbers there are."""
    merged = stored.groupBy("kind", "part").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("different"),
        F.sum("n").alias("n"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
    )
    # Every kind counts every row; the first stands for all.
    first = F.col("kind") == kinds[0]
    return merged.agg(
        F.coalesce(F.sum(F.when(first, F.col("n"))), F.lit(0)).alias("n"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("different"))), F.lit(0)).alias(k) for k in kinds],
    )
