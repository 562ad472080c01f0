"""Settings per file: which target, bindings and scripts a file is loaded with.

A control table has a row per kind of file. Files are matched to it by their paths, and those with equal
settings are loaded together in units of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.sequence import number_rows, running_total
from loadkit.session import materialise
from loadkit.sources.records import UNIT, UNIT_SIZE

FILES, SETTINGS = "files", "settings"
_CAPTURE = re.compile(r"\$\d")


def _filled(value: str, pattern: str) -> Column:
    """A setting with what the groups of a pattern found in the path of the file."""
    asked = [int(found[1]) for found in _CAPTURE.findall(value)]
    if not asked:
        return F.lit(value)
    if max(asked) > re.compile(pattern).groups:
        raise ValueError(f"{value!r} asks for a group that {pattern!r} does not have")
    return F.regexp_replace(F.col(UNIT), F.lit(pattern), F.lit(value))


def _setting(value, kind: T.DataType, pattern: str) -> Column:
    if isinstance(value, str):
        return _filled(value, pattern)
    if isinstance(value, list) and isinstance(kind.elementType, T.StringType):
        items = [F.lit(None).cast("string") if v is None else _filled(v, pattern) for v in value]
        return F.array(*items) if items else F.array().cast("array<string>")
    if isinstance(value, dict):
        pairs = [F.lit(x) for pair in sorted(value.items()) for x in pair]
        return F.create_map(*pairs).cast(kind) if pairs else F.lit(None).cast(kind)
    return F.lit(value).cast(kind)


def match_settings(listing: DataFrame, control: DataFrame) -> DataFrame:
    """The files of a listing with their `settings` as JSON; null where no row of `control` fits.

    `control` is configuration of a row per kind of file: `files`, a regular expression that must match
    the whole path, and the settings. The first row that fits in the order of `priority`, if there is
    such a column, or else of `files`, gives a file its settings. Text with `$1` and so on holds what
    the groups of the expression found, so one row can name the target of many files. The rows become
    one expression over the paths: files are not joined with anything.
    """
    rows: list[Row] = control.collect()
    order = "priority" if "priority" in control.columns else FILES
    rows.sort(key=lambda row: (row[order] is None, row[order]))
    names = [c for c in control.columns if c not in (FILES, "priority")]
    choices = []
    for row in rows:
        pattern = f"^(?:{row[FILES]})$"
        made = [
            _setting(row[n], control.schema[n].dataType, pattern).alias(n) for n in names if row[n] is not None
        ]
        choices.append(F.when(F.col(UNIT).rlike(pattern), F.to_json(F.struct(*made))))
    found = F.coalesce(*choices) if choices else F.lit(None).cast("string")
    return listing.select(UNIT, UNIT_SIZE, found.alias(SETTINGS))


def plan_files(matched: DataFrame, target_bytes: int | None = None) -> DataFrame:
    """The loads of files with settings: unit_no, _unit, _unit_size, settings.

    Files of equal settings share a load, or several of about `target_bytes` in the order of their
    paths. Loads are numbered in the order of settings, then of paths.
    """
    files = matched.filter(F.col(SETTINGS).isNotNull())
    placed = materialise(running_total(files, [SETTINGS, UNIT], F.col(UNIT_SIZE), "_start"), "files")
    first = placed.groupBy(SETTINGS).agg(F.min("_start").alias("_first"))
    start = F.col("_start") - F.col("_first")
    part = F.floor(start / F.lit(target_bytes)) if target_bytes else F.lit(0)
    parted = placed.join(first, SETTINGS).withColumn("_part", part.cast("bigint"))
    keys = [SETTINGS, "_part"]
    numbers = number_rows(parted.select(*keys).distinct(), keys, "unit_no")
    return materialise(parted.join(numbers, keys).select("unit_no", UNIT, UNIT_SIZE, SETTINGS), "plan")
