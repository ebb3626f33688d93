"""Selection of the input files that bronze does not hold yet, and the ledger that knows them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import Layout
from millrace.sources.landing import JSON_FILES, landing_batch, stamped
from millrace.sources.tables import BATCH, Partitions

# Characters that a reader would take for a pattern in a path.
PATTERN_CHARACTERS = str.maketrans({c: f"\\{c}" for c in "\\*?[]{},"})

# Partitions of the ledger. A look-up reads those of its files only.
LEDGER_BUCKETS = 64
# Files of one part of a load, whose paths are in the driver at a time.
FILES_AT_ONCE = 10_000


def all_bronze(spark: SparkSession, layout: Layout) -> DataFrame:
    """Bronze rows of the stream and of the backfills."""
    columns = layout.bronze_schema.names
    loaded = layout.backfill.read_or_empty(spark).select(*columns)
    return layout.bronze.read_or_empty(spark).select(*columns).unionByName(loaded)


def file_key(path: str | Column, by: str) -> Column:
    """The full path, or the bare file name (then two files of one name count as the same)."""
    path = F.col(path) if isinstance(path, str) else path
    return path if by == "path" else F.element_at(F.split(path, "/"), -1)


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and time of every JSON file below a folder; no content is read.

    ``path`` opens the file; ``source_file`` is the same path as bronze records it.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", JSON_FILES)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            "path",
            F.col("_metadata.file_path").alias("source_file"),
            "modificationTime",
            "length",
        )
    )


def ledger_bucket(path: str | Column) -> Column:
    """The ledger's partition of a file: by its bare name, so that look-ups by path and by name both find it."""
    return F.pmod(F.xxhash64(file_key(path, "name")), F.lit(LEDGER_BUCKETS)).cast("string")


def record_files(layout: Layout, rows: DataFrame, batch_id: int) -> None:
    """Enter the files of stored bronze rows into the ledger, under a batch number. Again changes nothing."""
    readings = F.lit(None)
    if layout.figures and "values" in rows.columns:
        readings = F.coalesce(F.sum(F.json_array_length("values")), F.lit(0))
    files = rows.groupBy("source_file").agg(F.count("*").alias("n"), readings.cast("bigint").alias("readings"))
    files = files.withColumn("bucket", ledger_bucket("source_file"))
    layout.ledger.overwrite_partitions(files.withColumn(BATCH, F.lit(batch_id)), arrange=False)


def held_files(spark: SparkSession, layout: Layout, files: DataFrame) -> DataFrame:
    """What the ledger holds in the partitions that ``files`` fall into; bronze itself is not read."""
    buckets = Partitions.of(files.select(ledger_bucket("source_file").alias("bucket")), "bucket")
    return layout.ledger.read_partitions(spark, buckets)


def pending_files(files: DataFrame, held: DataFrame, by: str = "path") -> DataFrame:
    """Those of ``files`` whose ``source_file`` is not in ``held``, in path order.

    By name, only the first path of each name counts.
    """
    files = files.withColumn("file_key", file_key("source_file", by))
    if by == "name":
        first = F.min(F.struct("path", "source_file", "modificationTime", "length")).alias("first")
        files = files.groupBy("file_key").agg(first).select("file_key", "first.*")
    known = held.select(file_key("source_file", by).alias("file_key")).distinct()
    return files.join(known, "file_key", "left_anti").drop("file_key").orderBy("path")


def pending_parts(
    spark: SparkSession, layout: Layout, folder: str, by: str = "path", files_at_once: int = FILES_AT_ONCE
) -> Iterator[list[str]]:
    """Paths of the files below a folder that the ledger does not hold, so many at a time."""
    files = files_in(spark, folder)
    part: list[str] = []
    for row in pending_files(files, held_files(spark, layout, files), by).select("path").toLocalIterator():
        part.append(row["path"])
        if len(part) == files_at_once:
            yield part
            part = []
    if part:
        yield part


def texts_of(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """The lines, or whole texts, of some files."""
    return stamped(spark.read.text([p.translate(PATTERN_CHARACTERS) for p in paths], wholetext=multi_line))


def pending_rows(
    spark: SparkSession,
    layout: Layout,
    folder: str,
    by: str = "path",
    multi_line: bool = False,
) -> DataFrame:
    """Bronze rows of the files not loaded yet. Only these files are opened, and none if nothing is new.

    For a look at moderately many files: their paths are all in the plan. ``backfill`` loads any number in parts.
    """
    paths = [p for part in pending_parts(spark, layout, folder, by) for p in part]
    if not paths:
        return spark.createDataFrame([], layout.bronze_schema)
    found = landing_batch(spark, [p.translate(PATTERN_CHARACTERS) for p in paths], layout.landing_schema, False, multi_line)
    return found.select(*layout.bronze_schema.names)
