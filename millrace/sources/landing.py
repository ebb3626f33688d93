"""JSON landing folder: stream and batch readers, and the schema they remember.

All text is read as UTF-8.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.edge import RESCUED, STAMPS, bronze_rows
from millrace.sources.tables import NO_FILE_TOO_OLD, is_missing, matching_paths

JSON_FILES = "*.json"
MAX_FILE_AGE = NO_FILE_TOO_OLD
# More top-level names than this become no columns.
MAX_COLUMNS = 10_000
# Fields that can become columns by themselves: names that need no quoting, and none that bronze has already.
COLUMN_NAME = re.compile(r"[\w -]*\w[\w -]*")
RESERVED = (*STAMPS, RESCUED, "ingestion_date", "bid", "load", "part")


def stamped(raw: DataFrame) -> DataFrame:
    """Raw rows with the file they came from and the time of ingestion."""
    return raw.withColumns(
        {"source_file": F.col("_metadata.file_path"), "ingestion_time": F.current_timestamp()}
    )


def landing_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    multi_line: bool = False,
    archive: str | None = None,
    recursive: bool = True,
    max_file_age: str = MAX_FILE_AGE,
    pattern: str = JSON_FILES,
    **limits: str | int,
) -> DataFrame:
    """Bronze rows of the JSON files of a folder, with ``recursive`` at any depth, as a stream, each file once."""
    texts = landing_texts(spark, folder, multi_line, archive, recursive, max_file_age, pattern, **limits)
    return bronze_rows(texts, schema)


def landing_texts(
    spark: SparkSession,
    folder: str,
    multi_line: bool = False,
    archive: str | None = None,
    recursive: bool = True,
    max_file_age: str = MAX_FILE_AGE,
    pattern: str = JSON_FILES,
    **limits: str | int,
) -> DataFrame:
    """The lines of the JSON files of a folder, with ``multi_line`` whole files, as a stream, each file once.

    Only names of the ``pattern`` are read, so half written ``.tmp`` files are left alone. ``archive`` moves files
    away once they are done, which keeps the listing of a busy folder short; it lies outside of the folder. ``limits``
    bound a batch: ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``. A file older than ``max_file_age`` before the newest
    one seen is never read; the driver remembers the names of the files of that span, so with very many
    files set it to the longest delay of a file and use ``archive``.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern).options(**limits)
    reader = reader.option("maxFileAge", max_file_age).option("recursiveFileLookup", recursive)
    if multi_line:
        reader = reader.option("wholetext", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return stamped(reader.load(folder))


def landing_batch(
    spark: SparkSession,
    folder: str | list[str],
    schema: T.StructType,
    recursive: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Bronze rows of the JSON files of a folder, or of some files."""
    reader = spark.read.option("pathGlobFilter", JSON_FILES).option("recursiveFileLookup", recursive)
    return bronze_rows(stamped(reader.text(folder, wholetext=multi_line)), schema)


def top_level_names(text: DataFrame, column: str = "value") -> DataFrame:
    """The distinct top-level names of a column of JSON objects, with the type they are read as."""
    names = text.select(F.explode(F.json_object_keys(column)).alias("column_name")).distinct()
    return names.withColumn("data_type", F.lit("string"))


def infer_schema(
    spark: SparkSession, folder: str, multi_line: bool = False, max_columns: int = MAX_COLUMNS, recursive: bool = True
) -> T.StructType:
    """Every top-level name in the JSON files of a folder, all read as text.

    Types are not inferred: clean data would turn the nested readings into an array of structs. With
    ``multi_line`` a file is one object or an array of objects. No name at all, or more than
    ``max_columns``, is an error, since the schema would be remembered.
    """
    reader = spark.read.option("pathGlobFilter", JSON_FILES).option("recursiveFileLookup", recursive)
    texts = reader.text(folder, wholetext=multi_line)
    if multi_line:
        array = F.from_json("value", "array<string>")
        texts = texts.select(F.explode(F.when(F.ltrim("value").startswith("["), array).otherwise(F.array("value"))).alias("value"))
    rows = top_level_names(texts).limit(max_columns + 1).collect()
    if not rows:
        raise ValueError(f"no JSON object in {folder}; are its files multi-line?")
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} top-level names in {folder}")
    names = sorted(r["column_name"] for r in rows)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def load_schema(spark: SparkSession, store: str) -> T.StructType | None:
    try:
        text = spark.read.option("wholetext", True).text(store).first()
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise
    return T.StructType.fromJson(json.loads(text[0])) if text else None


def save_schema(spark: SparkSession, store: str, schema: T.StructType) -> None:
    one = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
    one.write.mode("overwrite").text(store)


def remembered_schema(
    spark: SparkSession, folder: str, store: str, refresh: bool = False, multi_line: bool = False
) -> T.StructType:
    """The schema kept in ``store``; inferred from ``folder`` and kept there at the first call.

    ``refresh`` looks again and adds names that are new; columns once known never go away.
    """
    known = load_schema(spark, store)
    if known is not None and not refresh:
        return known
    found = infer_schema(spark, folder, multi_line)
    if known is not None:
        have = set(known.names)
        found = T.StructType([*known.fields, *[f for f in found.fields if f.name not in have]])
    if known is None or found != known:
        save_schema(spark, store, found)
    return found


def stored_schema(spark: SparkSession, store: str) -> tuple[int, T.StructType] | None:
    """The latest version that a growing schema has in ``store``."""
    versions = [int(p.rpartition("=")[2]) for p in matching_paths(spark, f"{store}/version=*")]
    for version in sorted(versions, reverse=True):
        # A version without its file was not written to the end.
        schema = load_schema(spark, f"{store}/version={version}")
        if schema is not None:
            return version, schema
    return None


def widened(schema: T.StructType, names: list[str], max_columns: int = MAX_COLUMNS) -> T.StructType:
    """``schema`` with new names as columns of text, in order of name.

    A name that differs from another column's by case only, or that can't be a column, is left out; so are those
    beyond ``max_columns``. Their values stay in ``rescued``.
    """
    taken = {n.lower() for n in (*schema.names, *RESERVED)}
    fields = list(schema.fields)
    for name in sorted(names):
        if len(fields) < max_columns and COLUMN_NAME.fullmatch(name) and name.lower() not in taken:
            taken.add(name.lower())
            fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields)


def grow_schema(spark: SparkSession, store: str, schema: T.StructType) -> None:
    """Keep ``schema`` as the next version, whatever versions there are."""
    latest = stored_schema(spark, store)
    if latest is None or latest[1] != schema:
        save_schema(spark, f"{store}/version={latest[0] + 1 if latest else 1}", schema)
