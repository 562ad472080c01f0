"""Binding: which record field feeds which target column, with what cast."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.casts import UnsupportedBinding, cast_expr, may_fail
from loadkit.sources.records import MALFORMED, UNIT, UNIT_SIZE, SchemaMissing

logger = logging.getLogger(__name__)

# Where Spark keeps the declared text length and the default of a column.
TEXT_TYPE_KEY, DEFAULT_KEY = "__CHAR_VARCHAR_TYPE_STRING", "CURRENT_DEFAULT"

# Why a row cannot be loaded, and what it was read as: both null for good rows.
ERROR = "_error"
RAW = "_raw"


class ArityError(ValueError):
    """The number of bound fields differs from the number of target columns."""


def bind(
    df: DataFrame,
    fields: Sequence[str],
    target: T.StructType,
    on_absent: str = "null",
    keep: Sequence[str] = (),
    errors: bool = False,
) -> DataFrame:
    """Bind the i-th field to the i-th target column, cast to its type.

    A field may feed several columns; fields that are not named are never read. A field that the
    records lack leaves its column null (`null`), sets it to the default of the table (`default`), or
    raises (`error`). `keep` passes columns through as they are. `errors`
    adds `_error`, which names the fields whose value could not be cast, and `_raw`, which holds the
    record as read; without it a failed cast is a null.
    """
    if len(fields) != len(target.fields):
        raise ArityError(f"{len(fields)} fields bound to {len(target.fields)} columns")
    known = {f.name: f for f in df.schema.fields}
    columns: list[Column] = []
    failures: list[tuple[str, Column]] = []
    for name, column in zip(fields, target.fields, strict=True):
        source = known.get(name)
        refused: Column | None = None
        if source is None:
            if on_absent == "error":
                raise SchemaMissing(f"no field {name!r} for column {column.name!r}")
            logger.warning("field %r is absent, column %r is left unset", name, column.name)
            value = _default(column) if on_absent == "default" else F.lit(None)
            value = value.cast(column.dataType)
        else:
            value = cast_expr(source, column.dataType)
            if may_fail(source, column.dataType):
                refused = F.col(f"`{name}`").isNotNull() & value.isNull()
        value, broken = _declared(value, column)
        columns.append(value.alias(column.name))
        wrong = [c for c in (refused, broken) if c is not None]
        if errors and wrong:
            failures.append((name, reduce(lambda a, b: a | b, wrong)))
    if errors:
        read = [F.col(f"`{name}`") for name in dict.fromkeys(fields) if name in known]
        columns += _error_columns(df, failures, read)
    return df.select(*columns, *keep)


def _declared(value: Column, column: T.StructField) -> tuple[Column, Column | None]:
    """A value under the declared text length of its column, and when it breaks what is declared.

    As in a database, spaces at the end that do not fit are cut and other text that does not fit is an
    error, and so is a null where none is allowed.
    """
    broken = [] if column.nullable else [value.isNull()]
    length = re.search(r"\((\d+)\)", (column.metadata or {}).get(TEXT_TYPE_KEY, ""))
    if length:
        most = int(length[1])
        broken.append(F.char_length(F.rtrim(value)) > most)
        value = F.when(F.char_length(F.rtrim(value)) <= most, F.substring(value, 1, most))
    return value, reduce(lambda a, b: a | b, broken) if broken else None


def _default(column: T.StructField) -> Column:
    """The default of a table column, else null."""
    text = (column.metadata or {}).get(DEFAULT_KEY)
    return F.expr(text) if text else F.lit(None)


def _error_columns(
    df: DataFrame, failures: list[tuple[str, Column]], read: list[Column]
) -> list[Column]:
    """Why a row is bad, and its values as read.

    A columnar scan stays limited to the bound fields. Text has to be parsed in full: a reader that
    skips a field does not see that it is malformed, so the whole record is named.
    """
    bad = reduce(lambda a, b: a | b, [failed for _, failed in failures], F.lit(False))
    reason = F.concat_ws(",", *[F.when(failed, F.lit(name)) for name, failed in failures])
    if MALFORMED in df.columns:
        malformed = F.col(MALFORMED)
        bad = malformed.isNotNull() | bad
        reason = F.when(malformed.isNotNull(), F.lit("malformed")).otherwise(reason)
        added = (MALFORMED, UNIT, UNIT_SIZE)
        record = [F.col(f"`{name}`") for name in df.columns if name not in added]
        text = F.coalesce(malformed, F.to_json(F.struct(*record)))
    else:
        text = F.to_json(F.struct(*read)) if read else F.lit(None).cast("string")
    # Good rows only pay for the test: both texts are built behind it.
    return [F.when(bad, reason).alias(ERROR), F.when(bad, text).alias(RAW)]


def strict(bound: DataFrame) -> DataFrame:
    """Fail the job that meets a bad row, so that nothing of the write is committed."""
    message = F.concat(F.lit("cannot load record, "), F.col(ERROR), F.lit(": "), F.col(RAW))
    passes = F.assert_true(F.col(ERROR).isNull(), message).isNull()
    return bound.filter(passes).drop(ERROR, RAW)


def bind_by_name(
    df: DataFrame,
    target: T.StructType,
    on_absent: str = "null",
    keep: Sequence[str] = (),
    errors: bool = False,
) -> DataFrame:
    """Bind fields to the target columns of the same name, by the session's rule for letter case."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda name: name) if exact else str.lower
    found: dict[str, list[str]] = {}
    for name in df.columns:
        found.setdefault(fold(name), []).append(name)
    names = []
    for column in target.fields:
        same = found.get(fold(column.name), [column.name])
        if len(same) > 1:
            raise SchemaMissing(f"fields {same} all match column {column.name!r}")
        names.append(same[0])
    return bind(df, names, target, on_absent, keep, errors)


def bind_expr(
    df: DataFrame,
    expressions: Mapping[str, str],
    target: T.StructType,
    keep: Sequence[str] = (),
    errors: bool = False,
) -> DataFrame:
    """Bind target columns to SQL expressions over the fields; each is cast to its column's type.

    An expression whose result is of a record type is cast like a field of that type.

    Columns without an expression take the default of the table. `errors` is as in `bind`; it names
    target columns.
    """
    unknown = set(expressions) - set(target.fieldNames())
    if unknown:
        raise SchemaMissing(f"no target columns {sorted(unknown)}")
    columns: list[Column] = []
    failures: list[tuple[str, Column]] = []
    for column in target.fields:
        refused: Column | None = None
        if column.name not in expressions:
            value = _default(column).cast(column.dataType)
        else:
            computed = F.expr(expressions[column.name])
            result = df.select(computed.alias(column.name)).schema.fields[0]
            try:
                value = cast_expr(result, column.dataType, computed)
            except UnsupportedBinding:
                value = computed.try_cast(column.dataType)
            refused = computed.isNotNull() & value.isNull()
        value, broken = _declared(value, column)
        columns.append(value.alias(column.name))
        wrong = [c for c in (refused, broken) if c is not None]
        if wrong:
            failures.append((column.name, reduce(lambda a, b: a | b, wrong)))
    if errors:
        # The fields that an expression names, as they were read; a columnar scan reads no others.
        text = " ".join(expressions.values()).lower()
        named = [n for n in df.columns if re.search(rf"(?<!\w){re.escape(n.lower())}(?!\w)", text)]
        columns += _error_columns(df, failures, [F.col(f"`{name}`") for name in named])
    return df.select(*columns, *keep)
