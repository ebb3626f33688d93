"""Landing folder to bronze."""

from __future__ import annotations

from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.catalog import Layout
from millrace.operators.edge import bronze_rows, rescued_names
from millrace.sinks.fanout import computed_once
from millrace.sources.backfill import record_files
from millrace.sources.landing import JSON_FILES, MAX_FILE_AGE, grow_schema, landing_texts, stored_schema, widened
from millrace.sources.tables import move_folder

# Take everything that is new, then stop. A long-lived run passes {"processingTime": "10 seconds"}.
DRAIN = {"availableNow": True}


def grown(spark: SparkSession, layout: Layout) -> Layout:
    """The layout with all columns that bronze has by now: those it declares, then those that came with the data."""
    stored = stored_schema(spark, layout.schema_store)
    if stored is None:
        return layout
    have = set(layout.landing_schema.names)
    new = [f for f in stored[1].fields if f.name not in have]
    return replace(layout, landing_schema=T.StructType([*layout.landing_schema.fields, *new]))


def store_texts(layout: Layout, texts: DataFrame, name: str, partition: dict[str, str | int], grow: bool) -> None:
    """Write the rows of some texts as one partition of ``bronze`` or ``backfill``, in the place of what is there.

    With ``grow``, names that no column has become columns of text first, so the rows they come in have them. A folder's
    rows are written beside it, looked at, and moved in with one rename; a catalog table's are kept while they are.
    """
    spark = texts.sparkSession
    layout = grown(spark, layout) if grow else layout
    dataset = getattr(layout, name)

    def rows(schema: T.StructType) -> DataFrame:
        return bronze_rows(texts, schema)

    def wider(written: DataFrame) -> T.StructType:
        # One row per name, of which there are few.
        return widened(layout.landing_schema, [r["name"] for r in rescued_names(written).collect()])

    schema = layout.landing_schema
    if dataset.is_path:
        stage = f"{layout.root}/_staging/{name}"
        seen = Observation()
        left = F.count_if(F.col("rescued").isNotNull())
        observed = rows(schema).observe(seen, F.count("*").alias("rows"), left.alias("left"))
        observed.write.mode("overwrite").parquet(stage)
        if grow and seen.get["left"]:
            schema = wider(spark.read.schema(layout.bronze_schema).parquet(stage))
            if schema != layout.landing_schema:
                grow_schema(spark, layout.schema_store, schema)
                rows(schema).write.mode("overwrite").parquet(stage)
        if seen.get["rows"]:
            place = "/".join(f"{k}={v}" for k, v in partition.items())
            move_folder(spark, stage, f"{dataset.location}/{place}")
        return
    with computed_once(rows(schema)) as found:
        if grow:
            schema = wider(found)
        if schema != layout.landing_schema:
            grow_schema(spark, layout.schema_store, schema)
            dataset = getattr(replace(layout, landing_schema=schema), name)
            found = rows(schema)
        dataset.widen(spark)
        values = {k: F.lit(v) for k, v in partition.items()}
        dataset.overwrite_partitions(found.withColumns(values), arrange=False)


def store_landing(layout: Layout, texts: DataFrame, batch_id: int, grow: bool = True) -> None:
    """Take one batch of landing texts into bronze, then into the ledger of files.

    The rows of a batch appear as one folder, with one rename. When the batch is run again, a folder that is there stays
    as it is, since other streams may follow its files already; a catalog table's partition is replaced.
    """
    spark = texts.sparkSession
    if not (layout.bronze.is_path and layout.bronze.batch_paths(spark, batch_id)):
        today = datetime.now(UTC).date().isoformat()
        store_texts(layout, texts, "bronze", {"ingestion_date": today, "bid": batch_id}, grow)
    record_files(layout, layout.bronze.read_batch(spark, batch_id), batch_id)


def start_bronze(
    spark: SparkSession,
    layout: Layout,
    landing: str,
    trigger: dict = DRAIN,
    multi_line: bool = False,
    archive: str | None = None,
    recursive: bool = True,
    max_file_age: str = MAX_FILE_AGE,
    grow: bool = True,
    pattern: str = JSON_FILES,
    **limits: str | int,
) -> StreamingQuery:
    """Append every new JSON file to bronze, once; a later run goes on where this one ended.

    Nothing is lost: see ``operators.edge``. With ``grow`` a field that is new becomes a column, in the batch that it
    comes in and from then on; ``grown`` gives the layout with these columns.
    """
    layout.bronze.prepare(spark)
    texts = landing_texts(spark, landing, multi_line, archive, recursive, max_file_age, pattern, **limits)
    return (
        texts.writeStream.foreachBatch(lambda batch, batch_id: store_landing(layout, batch, batch_id, grow))
        .option("checkpointLocation", layout.checkpoint("bronze"))
        .trigger(**trigger)
        .start()
    )
