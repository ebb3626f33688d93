"""Metric catalog, schemas and table layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from millrace.functions.times import grain_seconds, interval_seconds
from millrace.sources.tables import Dataset


@dataclass(frozen=True)
class Metric:
    name: str
    data_type: T.DataType


@dataclass(frozen=True)
class MetricCatalog:
    """The metrics a wide record has, with their types; fixes the schema of every batch."""

    metrics: tuple[Metric, ...]

    @property
    def names(self) -> list[str]:
        return [m.name for m in self.metrics]

    def fields(self) -> list[T.StructField]:
        return [T.StructField(m.name, m.data_type) for m in self.metrics]

    @staticmethod
    def of(**types: T.DataType) -> MetricCatalog:
        return MetricCatalog(tuple(Metric(n, t) for n, t in types.items()))


# Metric names and types of the wide record.
WIND_FARM = MetricCatalog.of(
    Wind_speed=T.DoubleType(),
    AirPres=T.DoubleType(),
    Ambient_temperature=T.DoubleType(),
    Humidity=T.DoubleType(),
    Power_output=T.DoubleType(),
    Rotor_rpm=T.IntegerType(),
    Error_code=T.IntegerType(),
    Brake_active=T.BooleanType(),
    Grid_connected=T.BooleanType(),
    Operation_mode=T.StringType(),
)

# The fields of one reading inside the JSON text of an envelope.
READING_ARRAY = T.ArrayType(
    T.StructType(
        [
            T.StructField("device_id", T.LongType()),
            T.StructField("metric", T.StringType()),
            T.StructField("timestampUtc", T.LongType()),
            T.StructField("datatype", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    )
)

# The statistics, one metric table each; defaults of window and watermark.
STATISTICS = ("avg", "min", "max", "stddev")
DEFAULT_WINDOW = "1 minute"
DEFAULT_WATERMARK = "30 seconds"

# The columns that are never metrics, and the types of those that get statistics.
NOT_METRICS = frozenset({"device_id", "event_time", "inserted_at"})
NUMERIC_TYPES = (T.DoubleType, T.IntegerType, T.FloatType, T.LongType)
NUMERIC_NAMES = frozenset(t.typeName() for t in NUMERIC_TYPES)

LANDING_SCHEMA = T.StructType([T.StructField("values", T.StringType())])


def numeric_columns(schema: T.StructType) -> list[str]:
    """Columns that get window statistics: double, int, float or long, and not a key or stamp."""
    types = {f.name: f.dataType.typeName() for f in schema.fields}
    return [name for name, kind in types.items() if kind in NUMERIC_NAMES and name not in NOT_METRICS]


@dataclass(frozen=True)
class Layout:
    """Where the layers live and how they are cut.

    ``root`` is a folder on storage that every executor sees; checkpoints always live there. With
    ``database`` the layers are catalog tables of that database, otherwise Parquet folders in
    ``root``. ``grain`` is the event-time span of one storage partition: the unit that a late row
    causes to be rebuilt; a multiple of ``window``. With ``shards`` each span is cut once more, by a hash of the device, so
    that a late row causes the partition of its span and shard to be rebuilt; another number of shards needs a rebuild of
    the layers. ``whole_seconds`` is the compatibility form of silver: times cut to
    seconds and one record per device and second. ``order_by`` names the bronze columns that say
    which of two readings of the same device, metric and instant came first; the position in the
    envelope follows them. With ``figures`` the streams keep figures beside each partition of silver and gold, so that reports
    do not read the layers.
    """

    root: str
    database: str | None = None
    catalog: MetricCatalog = WIND_FARM
    landing_schema: T.StructType = LANDING_SCHEMA
    order_by: tuple[str, ...] = ("ingestion_time", "source_file")
    grain: str = "hour"
    shards: int = 1
    window: str = DEFAULT_WINDOW
    watermark: str = DEFAULT_WATERMARK
    whole_seconds: bool = False
    figures: bool = False
    numeric: list[str] = field(init=False, compare=False)

    def __post_init__(self):
        if grain_seconds(self.grain) % interval_seconds(self.window):
            raise ValueError(f"a {self.grain} partition does not hold whole windows of {self.window}")
        if not 1 <= self.shards <= 10_000:
            raise ValueError("there are 1 to 10000 shards")
        object.__setattr__(self, "numeric", numeric_columns(self.silver_schema))

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def _dataset(
        self,
        name: str,
        schema: T.StructType,
        partition_by: tuple[str, ...] = (),
        sort_by: tuple[str, ...] = (),
    ) -> Dataset:
        location = f"{self.database}.{name}" if self.database else f"{self.root}/{name}"
        return Dataset(location, schema, partition_by, sort_by, tuple(c for c in sort_by if c == "device_id"))

    @property
    def schema_store(self) -> str:
        """Where the versions of a growing landing schema are."""
        return f"{self.root}/_schemas/bronze"

    @property
    def bronze_schema(self) -> T.StructType:
        """The declared fields come last, so that new ones follow."""
        return T.StructType(
            [
                T.StructField("source_file", T.StringType()),
                T.StructField("ingestion_time", T.TimestampType()),
                T.StructField("rescued", T.StringType()),
                *self.landing_schema.fields,
            ]
        )

    @property
    def readings_schema(self) -> T.StructType:
        order = [f for f in self.bronze_schema.fields if f.name in self.order_by]
        order.sort(key=lambda f: self.order_by.index(f.name))
        return T.StructType(
            [
                T.StructField("device_id", T.LongType()),
                T.StructField("metric", T.StringType()),
                T.StructField("value", T.StringType()),
                T.StructField("timestampUtc", T.LongType()),
                T.StructField(
                    "arrival",
                    T.StructType([*order, T.StructField("position", T.IntegerType())]),
                ),
                T.StructField("event_bucket", T.StringType()),
                T.StructField("bid", T.LongType()),
            ]
        )

    @property
    def silver_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("device_id", T.LongType()),
                T.StructField("event_time", T.TimestampType()),
                *self.catalog.fields(),
                T.StructField("inserted_at", T.TimestampType()),
                T.StructField("event_bucket", T.StringType()),
            ]
        )

    def gold_schema(self, statistic: str) -> T.StructType:
        silver = self.silver_schema
        metrics = [
            T.StructField(n, silver[n].dataType if statistic in ("min", "max") else T.DoubleType())
            for n in self.numeric
        ]
        return T.StructType(
            [
                T.StructField("device_id", T.LongType()),
                T.StructField("window_start", T.TimestampType()),
                T.StructField("window_end", T.TimestampType()),
                *metrics,
                T.StructField("inserted_at", T.TimestampType()),
                T.StructField("window_bucket", T.StringType()),
            ]
        )

    @property
    def partials_schema(self) -> T.StructType:
        silver = self.silver_schema
        moments = []
        for n in self.numeric:
            moments += [
                T.StructField(f"{n}_n", T.LongType()),
                T.StructField(f"{n}_mean", T.DoubleType()),
                T.StructField(f"{n}_m2", T.DoubleType()),
                T.StructField(f"{n}_min", silver[n].dataType),
                T.StructField(f"{n}_max", silver[n].dataType),
            ]
        return T.StructType(
            [
                T.StructField("device_id", T.LongType()),
                T.StructField("window_start", T.TimestampType()),
                T.StructField("window_end", T.TimestampType()),
                *moments,
                T.StructField("window_bucket", T.StringType()),
                T.StructField("bid", T.LongType()),
            ]
        )

    @property
    def bronze(self) -> Dataset:
        """Bronze rows of the stream; a batch has one folder, below the day on which it was taken."""
        parts = [T.StructField("ingestion_date", T.StringType()), T.StructField("bid", T.LongType())]
        return self._dataset("bronze", T.StructType([*self.bronze_schema.fields, *parts]), ("ingestion_date", "bid"))

    @property
    def backfill(self) -> Dataset:
        """Bronze rows loaded by batch, in parts of a bounded number of files. The silver stream does not follow them."""
        parts = [T.StructField("load", T.LongType()), T.StructField("part", T.LongType())]
        return self._dataset("bronze_backfill", T.StructType([*self.bronze_schema.fields, *parts]), ("load", "part"))

    @property
    def ledger(self) -> Dataset:
        """The files that bronze holds, by a hash of their bare name, written with each batch and load.

        ``n`` is the number of rows of a file; with ``figures``, ``readings`` is that of the readings in them.
        """
        fields = [("source_file", T.StringType()), ("n", T.LongType()), ("readings", T.LongType())]
        fields += [("bucket", T.StringType()), ("bid", T.LongType())]
        return self._dataset("bronze_files", T.StructType([T.StructField(n, t) for n, t in fields]), ("bucket", "bid"))

    @property
    def readings(self) -> Dataset:
        parts, order = ("event_bucket", "bid"), ("device_id", "timestampUtc")
        return self._dataset("readings", self.readings_schema, parts, order)

    @property
    def silver(self) -> Dataset:
        order = ("device_id", "event_time")
        return self._dataset("silver", self.silver_schema, ("event_bucket",), order)

    @property
    def changes(self) -> Dataset:
        """The silver partitions that a batch rebuilt: what the gold stream follows.

        Plain appends: an announcement that comes twice only causes the same work twice.
        """
        schema = T.StructType(
            [T.StructField("event_bucket", T.StringType()), T.StructField("bid", T.LongType())]
        )
        return self._dataset("silver_changes", schema)

    @property
    def partials(self) -> Dataset:
        parts, order = ("window_bucket", "bid"), ("device_id", "window_start")
        return self._dataset("window_partials", self.partials_schema, parts, order)

    @property
    def silver_figures(self) -> Dataset:
        return self._dataset("silver_figures", self.figures_schema("event_bucket"), ("event_bucket",))

    @property
    def gold_figures(self) -> Dataset:
        """One for all metric tables, which have the same windows."""
        return self._dataset("metrics_figures", self.figures_schema("window_bucket"), ("window_bucket",))

    def figures_schema(self, bucket: str) -> T.StructType:
        fields = [("kind", T.StringType()), ("part", T.LongType()), ("bits", T.BinaryType()), ("n", T.LongType())]
        fields += [("earliest", T.TimestampType()), ("latest", T.TimestampType()), (bucket, T.StringType())]
        return T.StructType([T.StructField(n, t) for n, t in fields])

    def gold(self, statistic: str) -> Dataset:
        parts, order = ("window_bucket",), ("device_id", "window_start")
        return self._dataset(f"metrics_{statistic}", self.gold_schema(statistic), parts, order)
