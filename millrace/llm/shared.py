"""What the operators share: reading tables, written intermediate tables, hashes, distributed running totals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_folder

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of bounded bytes, so that very long texts don't pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and whole whatever executor is lost later."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def small(df: DataFrame, most: int) -> DataFrame:
    """df, a written table of narrow rows, to be broadcast if it has at most so many of them; else joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def doc_crc(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string"))


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def running_total(
    df: DataFrame, group: str, key: str, ties: list[Column], value: str, before: str, bucket_chars: int = 3
) -> DataFrame:
    """df with column ``before``: the sum of ``value`` in rows of the group that come earlier by key, then ties.

    key is a hexadecimal hash. Its first characters split every group into 16 ** bucket_chars ranges, so
    that no task sorts a whole group; only the totals of the ranges are summed over a group. group must
    not be null.
    """
    df = df.withColumn("_range", F.substring(key, 1, bucket_chars))
    totals = df.groupBy(group, "_range").agg(F.sum(value).alias("_total"))
    ahead = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_range", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead"))
    inside = (
        Window.partitionBy(group, "_range").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    )
    found = df.withColumn(before, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        found.join(offsets, [group, "_range"])
        .withColumn(before, F.col(before) + F.col("_ahead"))
        .drop("_range", "_ahead")
    )


def utf8_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to most, or single ones above it."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
