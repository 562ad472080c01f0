from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.casts import (
    UnsupportedBinding,
    cast_error,
    cast_expr,
    may_fail,
    record_type,
    time_field,
    time_millis,
    time_text,
)

DAY_MILLIS = 86_400_000


def cast_one(spark, value, source, target):
    """The cast of one value and whether it counts as an error."""
    field = source if isinstance(source, T.StructField) else T.StructField("f", source)
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("f", field.dataType)]))
    return tuple(df.select(cast_expr(field, target), cast_error(field, target)).first())


@pytest.mark.parametrize(
    ("value", "source", "target", "expected"),
    [
        ("x", T.StringType(), T.StringType(), "x"),
        (1.5, T.DoubleType(), T.StringType(), "1.5"),
        ("2.5", T.StringType(), T.DoubleType(), 2.5),
        (2.9, T.DoubleType(), T.IntegerType(), 2),
        (2**31 - 1, T.LongType(), T.IntegerType(), 2**31 - 1),
        (-(2**63), T.LongType(), T.LongType(), -(2**63)),
        ("9", T.StringType(), T.LongType(), 9),
        (1.25, T.DoubleType(), T.DecimalType(12, 2), Decimal("1.25")),
        (7, T.IntegerType(), T.DecimalType(5, 1), Decimal("7.0")),
        (0, T.IntegerType(), T.DateType(), dt.date(1970, 1, 1)),
        (-1, T.LongType(), T.DateType(), dt.date(1969, 12, 31)),
        ("19000", T.StringType(), T.DateType(), dt.date(2022, 1, 8)),
        ("2024-02-29", T.StringType(), T.DateType(), dt.date(2024, 2, 29)),
        (0, T.LongType(), T.TimestampNTZType(), dt.datetime(1970, 1, 1)),
        (-1, T.LongType(), T.TimestampNTZType(), dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
        (1500, T.IntegerType(), T.TimestampNTZType(), dt.datetime(1970, 1, 1, 0, 0, 1, 500000)),
        ("1500", T.StringType(), T.TimestampNTZType(), dt.datetime(1970, 1, 1, 0, 0, 1, 500000)),
        ("2024-01-02 03:04:05", T.StringType(), T.TimestampNTZType(), dt.datetime(2024, 1, 2, 3, 4, 5)),
        (
            dt.datetime(1960, 1, 1, 0, 0, 0, 123456),
            T.TimestampNTZType(),
            T.TimestampNTZType(),
            dt.datetime(1960, 1, 1, 0, 0, 0, 123000),
        ),
    ],
)
def test_good_values(spark, value, source, target, expected):
    assert cast_one(spark, value, source, target) == (expected, False)


@pytest.mark.parametrize(
    ("value", "source", "target"),
    [
        ("x", T.StringType(), T.DoubleType()),
        ("1.x", T.StringType(), T.IntegerType()),
        (2**31, T.LongType(), T.IntegerType()),
        (1e12, T.DoubleType(), T.DecimalType(12, 2)),
        ("2024-02-30", T.StringType(), T.DateType()),
        ("2024-1-x", T.StringType(), T.DateType()),
        (2**63 - 1, T.LongType(), T.TimestampType()),
        (-(2**63), T.LongType(), T.TimestampNTZType()),
        ("soon", T.StringType(), T.TimestampType()),
        (DAY_MILLIS, time_field("f"), T.IntegerType()),
        (-1, time_field("f"), T.StringType()),
    ],
)
def test_bad_values_are_errors(spark, value, source, target):
    assert cast_one(spark, value, source, target) == (None, True)


SOURCES = [T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()]


@pytest.mark.parametrize("source", SOURCES, ids=str)
def test_nulls_stay_null_without_error(spark, source):
    assert cast_one(spark, None, source, T.StringType()) == (None, False)
    if not isinstance(source, T.DoubleType):
        assert cast_one(spark, None, source, T.DateType()) == (None, False)
        assert cast_one(spark, None, source, T.TimestampType()) == (None, False)


def test_time_of_day(spark):
    df = spark.createDataFrame([(0,), (DAY_MILLIS - 1,), (11_045_006,), (None,)], "t int")
    rows = df.select(time_millis(F.col("t")), time_text(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (0, "00:00:00.000"),
        (DAY_MILLIS - 1, "23:59:59.999"),
        (11_045_006, "03:04:05.006"),
        (None, None),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Lord_Howe"])
def test_local_timestamps_do_not_depend_on_the_session_time_zone(spark, zone):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", zone)
    # 02:30 does not exist in New York on this day.
    skipped = dt.datetime(2024, 3, 10, 2, 30, 0, 1500)
    df = session.createDataFrame([(skipped, 1_700_000_000_123)], "f timestamp_ntz, m long")
    got = df.select(
        cast_expr(df.schema["f"], T.TimestampNTZType()),
        cast_expr(df.schema["m"], T.TimestampNTZType()),
    ).first()
    assert got[0] == dt.datetime(2024, 3, 10, 2, 30, 0, 1000)
    assert got[1] == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)


@pytest.mark.parametrize(
    "kind",
    [
        T.BooleanType(),
        T.ByteType(),
        T.ShortType(),
        T.FloatType(),
        T.BinaryType(),
        T.DecimalType(10, 2),
        T.ArrayType(T.FloatType()),
        T.MapType(T.StringType(), T.StringType()),
        T.StructType([]),
    ],
    ids=str,
)
def test_other_types_cannot_be_bound(kind):
    with pytest.raises(UnsupportedBinding, match="'f'"):
        record_type(T.StructField("f", kind))


@pytest.mark.parametrize(
    ("source", "target"),
    [
        (T.DoubleType(), T.DateType()),
        (T.DoubleType(), T.TimestampType()),
        (T.TimestampType(), T.IntegerType()),
        (T.DateType(), T.DoubleType()),
    ],
    ids=str,
)
def test_meaningless_casts_are_rejected(spark, source, target):
    with pytest.raises(UnsupportedBinding):
        cast_expr(T.StructField("f", source), target)
    with pytest.raises(UnsupportedBinding):
        cast_expr(time_field("f"), T.DateType())


def test_native_time_type(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.timeType.enabled", "true")
    df = session.createDataFrame([(11_045_006,)], T.StructType([time_field("t")]))
    value = cast_expr(df.schema["t"], T.TimeType(3)).cast("string")
    assert df.select(value).first()[0].startswith("03:04:05.006")


VALUES = {
    T.StringType(): ["x", "1", "2024-01-02", ""],
    T.DoubleType(): [1e300, -1.5, float("nan"), float("inf")],
    T.IntegerType(): [2**31 - 1, -(2**31), 0],
    T.LongType(): [2**63 - 1, -(2**63), 0],
    T.DateType(): [dt.date(1, 1, 1), dt.date(9999, 12, 31)],
    T.TimestampNTZType(): [dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)],
}
TARGETS = [
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.DateType(),
    T.TimestampType(),
    T.TimestampNTZType(),
    T.DecimalType(5, 2),
]


@pytest.mark.parametrize("source", VALUES, ids=str)
@pytest.mark.parametrize("target", TARGETS, ids=str)
def test_casts_that_cannot_fail_never_do(spark, source, target):
    field = T.StructField("f", source)
    try:
        failed = cast_error(field, target)
    except UnsupportedBinding:
        return
    df = spark.createDataFrame([(v,) for v in VALUES[source]], T.StructType([field]))
    assert may_fail(field, target) or df.filter(failed).isEmpty()


def test_short_dates_are_errors_not_exceptions(spark):
    value, failed = cast_one(spark, "2024-1-2", T.StringType(), T.DateType())
    assert failed == (value is None)
