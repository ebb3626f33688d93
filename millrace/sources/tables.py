"""Tables and Parquet folders behind one small interface."""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition values that are written in a path, and in a path pattern, as they are.
PLAIN_NAME = re.compile(r"[A-Za-z0-9_.-]+")

# Spark's own default forgets files a week older than the newest one, and so loses them.
NO_FILE_TOO_OLD = "3650d"

# Names in one pattern when partition folders are looked up.
NAMES_AT_ONCE = 1_000

# Sizes of a Bloom filter that are tried while a file is written, each half of the one before; the smallest that fits stays.
# One size for all would take a megabyte in every file, however few rows the file has.
BLOOM_SIZES = 12

# Batch numbers from here down are compactions: FOLDED - n stands for the batches 0 to n of its partition.
FOLDED = -(10**12)
# The pattern of their names: thirteen digits or more.
FOLDED_NAMES = "-" + "[0-9]" * 13 + "*"
BATCH = "bid"

DYNAMIC = "spark.sql.sources.partitionOverwriteMode"
# Held while a table is created or the mode of a session is changed, not while rows are written.
_MODE_LOCK = Lock()
_writers: dict[str, list] = {}


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """The session replaces partitions for as long as any writer is inside."""
    session = spark._jsparkSession.sessionUUID()
    with _MODE_LOCK:
        count, before = _writers.get(session, (0, None))
        if not count:
            before = spark.conf.get(DYNAMIC)
            spark.conf.set(DYNAMIC, "dynamic")
        _writers[session] = [count + 1, before]
    try:
        yield
    finally:
        with _MODE_LOCK:
            count, before = _writers[session]
            _writers[session] = [count - 1, before]
            if count == 1:
                spark.conf.set(DYNAMIC, before)
                del _writers[session]


def path_exists(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def delete_folder(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Put a folder in the place of another; its files appear there at once."""
    path, to = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(to, True)
    system.mkdirs(to.getParent())
    if not system.rename(path, to):
        raise OSError(f"{path} could not be moved to {to}")


def make_folder(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def superseded(batches: list[int]) -> set[int]:
    """Of the batch numbers of one partition, those whose rows its latest compaction holds."""
    latest = min((n for n in batches if n <= FOLDED), default=None)
    if latest is None:
        return set()
    return {n for n in batches if n != latest and (n <= FOLDED or 0 <= n <= FOLDED - latest)}


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


@dataclass(frozen=True)
class Dataset:
    """A catalog table (``database.name``) or a Parquet folder (anything with a slash)."""

    location: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    # Order of the rows in a file: lets a scan for one device skip most row groups.
    sort_by: tuple[str, ...] = ()
    # Columns with Bloom filters in the files of a folder: a look-up of a value that a file lacks skips it.
    find_by: tuple[str, ...] = ()

    @property
    def is_path(self) -> bool:
        return "/" in self.location

    @property
    def is_batched(self) -> bool:
        """Whether the rows of a partition are kept by the batch that they came in."""
        return self.partition_by[1:] == (BATCH,)

    def batch_folders(self, spark: SparkSession, names: str = "*") -> dict[str, dict[int, str]]:
        """The folder of each batch, by partition folder; from names alone, no file is opened."""
        found: dict[str, dict[int, str]] = {}
        for path in matching_paths(spark, f"{self.location}/{self.partition_by[0]}={names}/{BATCH}=*"):
            partition, _, batch = path.rpartition(f"/{BATCH}=")
            found.setdefault(partition, {})[int(batch)] = path
        return found

    def live_folders(self, spark: SparkSession, names: str = "*") -> list[str]:
        """The folders whose rows count: those of all batches but the ones that a compaction stands for."""
        folders = []
        for batches in self.batch_folders(spark, names).values():
            old = superseded(list(batches))
            folders += [path for n, path in batches.items() if n not in old]
        return folders

    def batch_paths(self, spark: SparkSession, batch: int) -> list[str]:
        """The folders of one batch, in any partition."""
        return matching_paths(spark, f"{self.location}/*/{BATCH}={batch}")

    def batches(self, spark: SparkSession) -> set[int]:
        """The numbers of all batches."""
        if self.is_path:
            return {n for folders in self.batch_folders(spark).values() for n in folders}
        return {r[0] for r in self.read_or_empty(spark).select(BATCH).distinct().collect()}

    def read_batch(self, spark: SparkSession, batch: int) -> DataFrame:
        """The rows of one batch."""
        if not self.is_path:
            return self.read_or_empty(spark).where(F.col(BATCH) == batch)
        paths = self.batch_paths(spark, batch)
        reader = spark.read.schema(self.schema).option("basePath", self.location)
        return reader.parquet(*paths) if paths else self.empty(spark)

    def drop_batch(self, spark: SparkSession, batch: int) -> None:
        """Remove the rows of one batch from a folder; in a catalog table they stay until they are replaced."""
        for path in self.batch_paths(spark, batch) if self.is_path else ():
            delete_folder(spark, path)

    def exists(self, spark: SparkSession) -> bool:
        if not self.is_path:
            return spark.catalog.tableExists(self.location)
        # Asking the file system is one call; a reader would list every file of the folder first.
        return path_exists(spark, self.location)

    def read(self, spark: SparkSession) -> DataFrame:
        if self.is_path:
            reader = spark.read.schema(self.schema)
            # Batches that a compaction stands for, but has not deleted yet, are passed over.
            if self.is_batched and matching_paths(spark, f"{self.location}/*/{BATCH}={FOLDED_NAMES}"):
                return reader.option("basePath", self.location).parquet(*self.live_folders(spark))
            return reader.parquet(self.location)
        # A session keeps the file list of a table; streams write in sessions of their own.
        spark.catalog.refreshTable(self.location)
        return spark.table(self.location)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def read_or_empty(self, spark: SparkSession) -> DataFrame:
        return self.read(spark) if self.exists(spark) else self.empty(spark)

    def read_stream(self, spark: SparkSession, **options) -> DataFrame:
        """Only the rows that came after the last committed offset of the reading query."""
        reader = spark.readStream.option("maxFileAge", NO_FILE_TOO_OLD)
        reader = reader.options(**{k: v for k, v in options.items() if v is not None})
        if self.is_path:
            return reader.schema(self.schema).parquet(self.location)
        return reader.table(self.location)

    def held_values(self, spark: SparkSession, partitions: Partitions) -> list[str]:
        """Those of some partitions that may have rows; for a folder, the ones that exist."""
        if not self.is_path or not all(PLAIN_NAME.fullmatch(v) for v in partitions.values):
            return partitions.values
        key, found = self.partition_by[0], []
        for i in range(0, len(partitions.values), NAMES_AT_ONCE):
            names = ",".join(partitions.values[i : i + NAMES_AT_ONCE])
            found += [path.rpartition(f"/{key}=")[2] for path in matching_paths(spark, f"{self.location}/{key}={{{names}}}")]
        return found

    def read_partitions(self, spark: SparkSession, partitions: Partitions) -> DataFrame:
        """The rows of some partitions; the other folders are not even listed."""
        key = self.partition_by[0]
        if not partitions.values:
            return self.empty(spark)
        if not self.is_path or not all(PLAIN_NAME.fullmatch(v) for v in partitions.values):
            return self.read_or_empty(spark).where(F.col(key).isin(partitions.values))
        folders = []
        for i in range(0, len(partitions.values), NAMES_AT_ONCE):
            names = ",".join(partitions.values[i : i + NAMES_AT_ONCE])
            if self.is_batched:
                folders += self.live_folders(spark, f"{{{names}}}")
            else:
                folders += matching_paths(spark, f"{self.location}/{key}={{{names}}}")
        if not folders:
            return self.empty(spark)
        return spark.read.schema(self.schema).option("basePath", self.location).parquet(*folders)

    @property
    def _file_options(self) -> dict[str, str]:
        if not self.find_by:
            return {}
        sizes = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.candidates.number": str(BLOOM_SIZES)}
        return {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.find_by} | sizes

    def _fitted(self, frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def arranged(self, frame: DataFrame) -> DataFrame:
        """Rows of one partition together and in order, so that it becomes a few large files.

        A rebalance, not a repartition: adaptive execution splits a partition too large for a task.
        Without it every task would write a small file into every partition. ``frame`` may have more columns.
        """
        frame = frame.hint("rebalance", *[F.col(c) for c in self.partition_by])
        return frame.sortWithinPartitions(*self.partition_by, *self.sort_by)

    def _arranged(self, frame: DataFrame) -> DataFrame:
        return self.arranged(self._fitted(frame))

    def append_stream(self, frame: DataFrame, checkpoint: str, trigger: dict):
        writer = (
            frame.select(self.schema.names)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
        )
        return writer.start(self.location) if self.is_path else writer.toTable(self.location)

    def append(self, frame: DataFrame) -> None:
        writer = self._fitted(frame).write.mode("append")
        if self.is_path:
            writer.parquet(self.location)
        else:
            writer.format("parquet").saveAsTable(self.location)

    def overwrite(self, frame: DataFrame) -> None:
        """Replace the whole dataset, also the partitions that the new rows do not have."""
        writer = self._arranged(frame).write.mode("overwrite").partitionBy(*self.partition_by)
        if self.is_path:
            writer.options(partitionOverwriteMode="static", **self._file_options).parquet(self.location)
        else:
            # No mode given here: a table would remember it and apply it to every later write.
            writer.format("parquet").saveAsTable(self.location)

    def overwrite_partitions(self, frame: DataFrame, arrange: bool = True) -> None:
        """Replace exactly the partitions that ``frame`` has rows for; create if missing.

        Without ``arrange`` every task writes its rows as they are: no shuffle, for rows that are arranged or of one partition.
        """
        frame = self._arranged(frame) if arrange else self._fitted(frame)
        if self.is_path:
            (
                frame.write.mode("overwrite")
                .options(partitionOverwriteMode="dynamic", **self._file_options)
                .partitionBy(*self.partition_by)
                .parquet(self.location)
            )
            return
        spark = frame.sparkSession
        with _MODE_LOCK:
            if not self.exists(spark):
                self._create(spark)
        # For tables the mode is taken from the session only.
        with dynamic_overwrite(spark):
            frame.write.mode("overwrite").insertInto(self.location)

    def widen(self, spark: SparkSession) -> None:
        """Add the columns that a catalog table does not have yet; a folder needs none."""
        if self.is_path or not self.exists(spark):
            return
        have = {c.lower() for c in spark.table(self.location).columns}
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields if f.name.lower() not in have]
        if new:
            spark.sql(f"ALTER TABLE {self.location} ADD COLUMNS ({', '.join(new)})")

    def prepare(self, spark: SparkSession) -> None:
        """Make the dataset without rows where it is missing, so that a stream can follow it."""
        if self.is_path:
            make_folder(spark, self.location)
        elif not self.exists(spark):
            self._create(spark)

    def _create(self, spark: SparkSession) -> None:
        writer = self.empty(spark).write.format("parquet").partitionBy(*self.partition_by)
        writer.mode("ignore").saveAsTable(self.location)


@dataclass(frozen=True)
class Partitions:
    """A set of partition values, by name. There are never more than folders, which the driver lists anyway."""

    frame: DataFrame
    values: list[str]

    @staticmethod
    def of(frame: DataFrame, column: str) -> Partitions:
        distinct = frame.select(column).distinct()
        values = [r[0] for r in distinct.collect()]
        if None in values:
            raise ValueError(f"rows without {column} have no partition")
        return Partitions(distinct, sorted(values))

    @staticmethod
    def named(spark: SparkSession, column: str, values: list[str]) -> Partitions:
        return Partitions(spark.createDataFrame([(v,) for v in sorted(values)], f"{column} string"), sorted(values))

    @staticmethod
    def of_batch(spark: SparkSession, dataset: Dataset, batch: int) -> Partitions:
        """The partitions of a folder that a batch has rows in, from names alone; names must need no escaping."""
        key = dataset.partition_by[0]
        folders = [path.rpartition(f"/{BATCH}=")[0] for path in dataset.batch_paths(spark, batch)]
        return Partitions.named(spark, key, [folder.rpartition(f"/{key}=")[2] for folder in folders])
