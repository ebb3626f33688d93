"""Landing texts to bronze rows, with nothing lost.

Every JSON object gives one row: the declared fields as columns, and in ``rescued``, as JSON text, the fields that are not
declared or whose value does not fit the declared type. A text that is no JSON object, or one that columns can't hold (a
field that comes twice, something behind the object), is in ``rescued`` as it is. So ``rescued`` is null where the
columns say everything. A declared field of type string keeps nested JSON as text. Fields in ``rescued`` keep their JSON
types; of numbers, what a decimal of 38 digits cannot hold becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "rescued"
STAMPS = ("source_file", "ingestion_time")

_ITEM, _OBJECTS = "_item", "_objects"
NESTED = (T.ArrayType, T.MapType, T.StructType)


def items_of(text: Column) -> Column:
    """The objects of a JSON array; any other text is its own only item."""
    array = F.from_json(text, "array<string>")
    objects = (F.size(array) > 0) & F.forall(array, lambda item: F.coalesce(item.rlike(r"^\s*\{"), F.lit(False)))
    return F.when(text.rlike(r"^\s*\[") & objects, array).otherwise(F.array(text))


def objects_of(item: Column) -> Column:
    """The objects in a text, each as name and text of its top-level fields; null where it is no JSON.

    In brackets, a text with something behind the object is no JSON, rather than read to the object's end.
    """
    return F.from_json(F.concat(F.lit("["), item, F.lit("]")), "array<map<string, string>>")


def typed(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, NESTED):
        return F.from_json(text, data_type)
    return text.try_cast(data_type)


def bronze_rows(texts: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """source_file, ingestion_time, rescued and the fields of ``schema``, from texts with the first two columns.

    Blank texts give no row. Narrow: no shuffle, works on a stream.
    """
    lines = texts.where(F.col(text).rlike(r"\S"))
    items = lines.select(*STAMPS, F.explode(items_of(F.col(text))).alias(_ITEM))
    rows = items.select("*", objects_of(F.col(_ITEM)).alias(_OBJECTS))
    item, objects = F.col(_ITEM), F.col(_OBJECTS)
    fields = F.when(F.size(objects) == 1, F.get(objects, 0))

    raw = {f.name: F.try_element_at(fields, F.lit(f.name)) for f in schema.fields}
    columns = {f.name: typed(raw[f.name], f.dataType) for f in schema.fields}
    unfit = [
        F.when(raw[f.name].isNotNull() & columns[f.name].isNull(), F.lit(f.name))
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]

    def left_over(name: Column, _: Column) -> Column:
        over = ~name.isin(schema.names)
        return over | F.array_contains(F.array_compact(F.array(*unfit)), name) if unfit else over

    names = F.map_keys(fields)
    sound = fields.isNotNull() & (F.size(F.array_distinct(names)) == F.size(names))
    # Most texts have nothing left over, and are parsed once only.
    as_variant = F.try_variant_get(F.try_parse_json(item), "$", "map<string, variant>")
    rest = F.coalesce(F.to_json(F.map_filter(as_variant, left_over)), item)
    rescued = F.when(~sound, item).when(F.size(F.map_filter(fields, left_over)) > 0, rest)
    return rows.select(*STAMPS, rescued.alias(RESCUED), *[c.alias(n) for n, c in columns.items()])


def rescued_names(bronze: DataFrame) -> DataFrame:
    """The distinct names of fields in ``rescued``; texts that are no objects have none."""
    return bronze.select(F.explode(F.json_object_keys(RESCUED)).alias("name")).distinct()


def rescued_fields(bronze: DataFrame) -> DataFrame:
    """One row per field in ``rescued``: source_file, name, JSON type and JSON text of the value."""
    objects = bronze.where(f"{RESCUED} IS NOT NULL").select("source_file", F.try_parse_json(RESCUED).alias("_object"))
    fields = bronze.sparkSession.tvf.variant_explode(F.col("_object").outer())
    return (
        objects.lateralJoin(fields)
        .where("key IS NOT NULL")
        .select(
            "source_file",
            F.col("key").alias("name"),
            F.schema_of_variant("value").alias("type"),
            F.to_json("value").alias("value"),
        )
    )


def rescued_texts(bronze: DataFrame) -> DataFrame:
    """source_file and text of what was no JSON object."""
    is_object = F.json_object_keys(RESCUED).isNotNull()
    return bronze.where(F.col(RESCUED).isNotNull() & ~is_object).select("source_file", F.col(RESCUED).alias("text"))
