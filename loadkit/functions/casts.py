"""Casts from record fields to the types of target columns, and the test for failed casts.

Everything is a native expression, so casts stay inside whole-stage code generation. `try_cast` turns
a bad value into null; `cast_error` tells that null apart from a null in the source.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record types that can be bound.
STRING, DOUBLE, INT, LONG = "string", "double", "int", "long"
TIMESTAMP, DATE, TIME = "timestamp", "date", "time"

# The date text form, the last millisecond of a day, the largest epoch in milliseconds
# that fits a timestamp of microseconds.
DATE_FORMAT = "yyyy-MM-dd"
LAST_MILLI_OF_DAY = 86_399_999
MAX_EPOCH_MILLIS = 9_223_372_036_854_775

RECORD_TYPE_KEY = "record_type"

_BY_SPARK_TYPE = {
    T.StringType: STRING,
    T.DoubleType: DOUBLE,
    T.IntegerType: INT,
    T.LongType: LONG,
    T.TimestampType: TIMESTAMP,
    T.TimestampNTZType: TIMESTAMP,
    T.DateType: DATE,
    T.TimeType: TIME,
}


class UnsupportedBinding(TypeError):
    """A record field has a type that cannot be bound to the target column."""


def time_field(name: str) -> T.StructField:
    """A record field that holds milliseconds of day as an int."""
    return T.StructField(name, T.IntegerType(), metadata={RECORD_TYPE_KEY: TIME})


def record_type(field: T.StructField) -> str:
    """The record type of a source field; raises for types that cannot be bound."""
    tagged = (field.metadata or {}).get(RECORD_TYPE_KEY)
    kind = tagged or _BY_SPARK_TYPE.get(type(field.dataType))
    if kind is None:
        raise UnsupportedBinding(
            f"field {field.name!r} has type {field.dataType.simpleString()}, which cannot be bound"
        )
    return kind


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def millis_to_timestamp(millis: Column, target: T.DataType) -> Column:
    """Epoch milliseconds to a timestamp; out-of-range values become null."""
    millis = millis.try_cast("bigint")
    if isinstance(target, T.TimestampNTZType):
        value = F.timestamp_add("MILLISECOND", millis, _epoch())
    else:
        value = F.timestamp_millis(millis)
    return F.when(millis.between(-MAX_EPOCH_MILLIS, MAX_EPOCH_MILLIS), value)


def truncate_to_millis(ts: Column, source: T.DataType) -> Column:
    """Drop everything below a millisecond."""
    if not isinstance(source, T.TimestampNTZType):
        return F.date_trunc("MILLISECOND", ts)
    # date_trunc would move the local time through the session time zone.
    below = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("int") % 1000
    return F.timestamp_add("MICROSECOND", -below, ts)


def days_to_date(days: Column) -> Column:
    """Days since 1970-01-01 to a date."""
    return F.date_from_unix_date(days.try_cast("int"))


def text_to_date(text: Column) -> Column:
    """A day number in text form, or else a `yyyy-MM-dd` date."""
    return F.coalesce(days_to_date(text), F.try_to_date(text, DATE_FORMAT))


def time_millis(value: Column) -> Column:
    """Milliseconds of day as an int; values outside a day become null."""
    millis = value.try_cast("int")
    return F.when(millis.between(0, LAST_MILLI_OF_DAY), millis)


def time_text(value: Column) -> Column:
    """Milliseconds of day as `HH:mm:ss.SSS`, independent of the session time zone."""
    moment = F.timestamp_add("MILLISECOND", time_millis(value), _epoch())
    time = F.substr(moment.cast("string"), F.lit(12))
    # The text of a timestamp leaves out zeros at the end.
    return F.rpad(F.when(F.length(time) == 8, F.concat(time, F.lit("."))).otherwise(time), 12, "0")


def cast_expr(source: T.StructField, target: T.DataType, value: Column | None = None) -> Column:
    """The cast of a record field to the type of a target column."""
    kind = record_type(source)
    col = F.col(f"`{source.name}`") if value is None else value
    native = source.dataType

    if kind == TIME and not isinstance(native, T.TimeType):
        if isinstance(target, T.StringType):
            return time_text(col)
        if isinstance(target, T.TimeType):
            return time_text(col).try_cast(target)
        if isinstance(target, T.IntegerType | T.LongType):
            return time_millis(col).cast(target)
        raise _no_cast(source, target)

    if isinstance(target, T.TimestampType | T.TimestampNTZType):
        if kind in (INT, LONG) or isinstance(native, T.IntegerType | T.LongType):
            return millis_to_timestamp(col, target)
        if kind == TIMESTAMP:
            return truncate_to_millis(col, native).cast(target)
        if kind == DATE:
            return col.cast(target)
        if kind == STRING:
            moment = truncate_to_millis(col.try_cast(target), target)
            return F.coalesce(millis_to_timestamp(col, target), moment)
        raise _no_cast(source, target)

    if isinstance(target, T.DateType):
        if isinstance(native, T.IntegerType | T.LongType):
            return days_to_date(col)
        if kind == STRING:
            return text_to_date(col)
        if kind in (DATE, TIMESTAMP):
            return col.cast(target)
        raise _no_cast(source, target)

    if isinstance(target, T.StringType):
        return col.cast(target)
    if isinstance(target, T.NumericType) and kind in (DATE, TIMESTAMP):
        raise _no_cast(source, target)
    return col.try_cast(target)


def may_fail(source: T.StructField, target: T.DataType) -> bool:
    """Whether a value can be present and its cast null; most numbers and times always fit."""
    native, kind = source.dataType, record_type(source)
    if kind == TIME and not isinstance(native, T.TimeType):
        return True
    if native == target or isinstance(target, T.StringType):
        return False
    temporal = T.DateType | T.TimestampType | T.TimestampNTZType
    if kind in (DATE, TIMESTAMP):
        return not isinstance(target, temporal)
    if isinstance(native, T.IntegerType):
        return not isinstance(target, T.LongType | T.DoubleType | temporal)
    return not (isinstance(native, T.LongType) and isinstance(target, T.DoubleType))


def cast_error(source: T.StructField, target: T.DataType, value: Column | None = None) -> Column:
    """True where a value is present but cannot be cast."""
    col = F.col(f"`{source.name}`") if value is None else value
    return col.isNotNull() & cast_expr(source, target, value).isNull()


def _no_cast(source: T.StructField, target: T.DataType) -> UnsupportedBinding:
    return UnsupportedBinding(
        f"field {source.name!r} ({record_type(source)}) cannot be bound to {target.simpleString()}"
    )
