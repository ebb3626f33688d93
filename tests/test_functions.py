import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import READING_ARRAY, WIND_FARM, Layout, numeric_columns
from millrace.functions.casts import lenient_cast
from millrace.functions.times import (
    FIRST_MILLI,
    LAST_MILLI,
    bucket_of_instant,
    bucket_of_millis,
    in_range,
    instant,
    interval_seconds,
    millis_of_ntz,
    ntz,
    whole_second_instant,
)

SAMPLE = 1774894923509


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def millis(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "ms bigint")


def test_milliseconds_are_kept(spark):
    row = millis(spark, SAMPLE).select(
        F.unix_millis(instant("ms")).alias("exact"), F.unix_millis(whole_second_instant(F.col("ms"))).alias("whole")
    ).first()
    assert row["exact"] == SAMPLE
    assert row["whole"] == SAMPLE // 1000 * 1000


def test_whole_seconds_before_the_epoch(spark):
    row = millis(spark, -1).select(F.unix_millis(whole_second_instant(F.col("ms"))).alias("whole")).first()
    assert row["whole"] == -1000


def test_autumn_clock_change_keeps_both_instants(new_york):
    first, second = 1730611800000, 1730615400000  # 2024-11-03 05:30Z and 06:30Z
    frame = millis(new_york, first, second)
    assert frame.select(instant("ms").alias("t")).distinct().count() == 2
    shown = [r[0] for r in frame.select(ntz(instant("ms")).cast("string")).collect()]
    assert shown == ["2024-11-03 05:30:00", "2024-11-03 06:30:00"]
    back = frame.select(ntz(instant("ms")).alias("w")).select(millis_of_ntz("w").alias("ms"))
    assert [r[0] for r in back.collect()] == [first, second]


@pytest.mark.parametrize("grain,expected", [("day", "2024-11-03"), ("hour", "2024-11-03T05"), ("quarter", "2024-11-03T05-30"), ("20 minutes", "2024-11-03T05-20")])
def test_buckets_do_not_depend_on_the_zone(new_york, grain, expected):
    row = millis(new_york, 1730611800000).select(
        bucket_of_millis(F.col("ms"), grain).alias("a"), bucket_of_instant(instant("ms"), grain).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (expected, expected)


def test_bucket_before_the_epoch(spark):
    for grain, name in [("hour", "1969-12-31T23"), ("quarter", "1969-12-31T23-45"), ("5 minutes", "1969-12-31T23-55"), ("1 minute", "1969-12-31T23-59")]:
        assert millis(spark, -1).select(bucket_of_millis(F.col("ms"), grain)).first()[0] == name


def test_time_range(spark):
    rows = millis(spark, FIRST_MILLI - 1, FIRST_MILLI, LAST_MILLI, LAST_MILLI + 1, None)
    assert [r[0] for r in rows.select(in_range(F.col("ms"))).collect()] == [False, True, True, False, None]
    kept = rows.where(in_range(F.col("ms")))
    assert kept.where(instant("ms").isNotNull()).count() == 2
    names = [r[0] for r in kept.select(bucket_of_millis(F.col("ms"), "day")).collect()]
    assert names == ["0001-01-01", "9999-12-31"]


def test_intervals():
    assert [interval_seconds(t) for t in ("30 seconds", "1 minute", "2 hours", "1 day")] == [30, 60, 7200, 86400]


@pytest.mark.parametrize(
    "text,number,integer,flag",
    [
        ("3.0", 3.0, 3, None),
        ("3.9", 3.9, 3, None),
        ("-3.9", -3.9, -3, None),
        ("x", None, None, None),
        ("", None, None, None),
        ("1", 1.0, 1, True),
        ("true", None, None, True),
        ("1.0", 1.0, 1, None),
        ("0", 0.0, 0, False),
        ("9e18", 9e18, None, None),
        ("NaN", float("nan"), None, None),
        (None, None, None, None),
    ],
)
def test_dirty_text(spark, text, number, integer, flag):
    row = spark.createDataFrame([(text,)], "t string").select(
        lenient_cast(F.col("t"), T.DoubleType()).alias("d"),
        lenient_cast(F.col("t"), T.IntegerType()).alias("i"),
        lenient_cast(F.col("t"), T.BooleanType()).alias("b"),
        lenient_cast(F.col("t"), T.StringType()).alias("s"),
    ).first()
    assert row["d"] == number or (row["d"] != row["d"] and number != number)
    assert (row["i"], row["b"], row["s"]) == (integer, flag, text)


def test_long_cast_is_exact(spark):
    rows = spark.createDataFrame([("9007199254740993",), ("2.7",), ("1e30",), ("x",)], "t string")
    found = [r[0] for r in rows.select(lenient_cast(F.col("t"), T.LongType())).collect()]
    assert found == [9007199254740993, 2, None, None]


def test_catalog_gives_seven_numeric_metrics():
    layout = Layout("/nowhere")
    assert layout.numeric == WIND_FARM.names[:7]
    assert layout.gold_schema("min")["Rotor_rpm"].dataType == T.IntegerType()
    assert layout.gold_schema("avg")["Rotor_rpm"].dataType == T.DoubleType()
    assert READING_ARRAY.elementType.names == ["device_id", "metric", "timestampUtc", "datatype", "value"]


def test_numeric_rule():
    schema = T.StructType(
        [
            T.StructField("device_id", T.LongType()),
            T.StructField("a", T.FloatType()),
            T.StructField("b", T.LongType()),
            T.StructField("c", T.ShortType()),
            T.StructField("d", T.DecimalType(10, 2)),
            T.StructField("e", T.StringType()),
            T.StructField("f", T.BooleanType()),
        ]
    )
    assert numeric_columns(schema) == ["a", "b"]


def test_windows_must_fit_the_partition():
    with pytest.raises(ValueError):
        Layout("/nowhere", grain="hour", window="7 minutes")


@pytest.mark.parametrize("grain", ["7 minutes", "90 seconds", "0 minutes", "2 hours"])
def test_grains_divide_the_hour(grain):
    with pytest.raises(ValueError):
        Layout("/nowhere", grain=grain, window="1 second")
