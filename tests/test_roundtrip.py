"""What is loaded is what was sent, for every type that can be bound."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from loadkit.functions.casts import time_field
from loadkit.operators.binding import bind
from loadkit.operators.loading import create_core, load_staged
from loadkit.context import new_context

SOURCE = T.StructType(
    [
        T.StructField("f_string", T.StringType()),
        T.StructField("f_double", T.DoubleType()),
        T.StructField("f_int", T.IntegerType()),
        T.StructField("f_long", T.LongType()),
        T.StructField("f_timestamp", T.LongType()),
        T.StructField("f_date", T.IntegerType()),
        T.StructField("f_date_text", T.StringType()),
        time_field("f_time"),
        T.StructField("f_cents", T.DoubleType()),
    ]
)
FIELDS = [*SOURCE.fieldNames()[:8], "f_time", "f_cents"]
DAY = dt.date(1970, 1, 1)
START = dt.datetime(1970, 1, 1)


def target():
    return T.StructType.fromDDL(
        "c_string string, c_double double, c_int int, c_long bigint, c_timestamp timestamp_ntz, "
        "c_date date, c_date2 date, c_time int, c_time_text string, c_decimal decimal(12,2)"
    )


def load(spark, db, rows):
    core, ctx = f"{db}.c{new_context().table_id}", new_context()
    create_core(spark, core, target())
    records = spark.createDataFrame(rows, SOURCE)
    result = load_staged(bind(records, FIELDS, target(), errors=True), core, ctx)
    assert result.rows == len(rows)
    return [tuple(r)[:10] for r in spark.table(core).collect()]


def expected(row):
    text, double, number, long, millis, days, day_text, time, cents = row

    def if_set(value, build):
        return None if value is None else build(value)

    clock = if_set(time, lambda t: (START + dt.timedelta(milliseconds=t)).strftime("%H:%M:%S.%f")[:12])
    return (
        text,
        double,
        number,
        long,
        if_set(millis, lambda m: START + dt.timedelta(milliseconds=m)),
        if_set(days, lambda d: DAY + dt.timedelta(days=d)),
        if_set(day_text, dt.date.fromisoformat),
        time,
        clock,
        if_set(cents, lambda c: Decimal(repr(c)).quantize(Decimal("0.01"))),
    )


def test_named_cases(spark, db):
    rows = [
        ("quotes \" and | and \n and é", 0.5, 1, 2, 0, 0, "1970-01-01", 0, 1.25),
        (None,) * 9,
        ("", -1.5, 2**31 - 1, 2**63 - 1, -1, -1, "1969-12-31", 86_399_999, -9999999999.99),
        ("x", 1e300, -(2**31), -(2**63), 1_700_000_000_123, 19_000, "2024-02-29", 1, 0.0),
    ]
    assert sorted(load(spark, db, rows), key=repr) == sorted(map(expected, rows), key=repr)


values = st.tuples(
    st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
    st.none() | st.floats(allow_nan=False),
    st.none() | st.integers(-(2**31), 2**31 - 1),
    st.none() | st.integers(-(2**63), 2**63 - 1),
    st.none() | st.integers(-2_000_000_000_000, 4_000_000_000_000),
    st.none() | st.integers(-100_000, 100_000),
    st.none() | st.dates(dt.date(1900, 1, 1), dt.date(2200, 1, 1)).map(str),
    st.none() | st.integers(0, 86_399_999),
    st.none() | st.integers(-10**9, 10**9).map(lambda c: c / 100),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values, max_size=20))
def test_any_values(spark, db, rows):
    assert sorted(load(spark, db, rows), key=repr) == sorted(map(expected, rows), key=repr)
