"""ELT over loaded rows: append, keyed merge, purge and time-series roll-up.

File tables know no MERGE, DELETE or UPDATE, so each is a rewrite of no more than the files it has
to touch. A rewrite of a whole table goes to a new folder which then becomes the table's location:
readers see the old rows until that one catalog change and the new rows after it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext, with_context
from loadkit.operators.keyfilter import FILTER_FROM, KeyFilter, key_filter
from loadkit.operators.loading import LOAD_COLUMNS, LoadResult, load_batch
from loadkit.session import (
    discard,
    materialised,
    partition_columns,
    same_values,
    setting,
    table_location,
)


class DuplicateKeys(ValueError):
    """Several staged rows have one key, and nothing says which of them to merge."""


@dataclass(frozen=True)
class MergeResult:
    """How many rows of the core table were replaced and how many were added."""

    updated: int
    inserted: int


def publish_append(spark: SparkSession, staging: str, core: str) -> LoadResult:
    """Append staged rows to the core table by column name."""
    return load_batch(spark.table(staging), core)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest `order_by` of each key; nulls order first.

    An aggregate rather than a window: each task sends on one row per key, so a key that holds a
    large part of the rows costs no more than any other. Equal `order_by` values fall back to the
    remaining columns, which makes the result the same on every run; maps are compared as text.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if any(_has_map(df.schema[c].dataType) for c in rest):
        told = [F.to_json(F.struct(c)) if _has_map(df.schema[c].dataType) else F.col(c) for c in rest]
        place = F.struct(*order_by, *[t.alias(f"_{i}") for i, t in enumerate(told)])
        latest = F.max_by(F.struct(*order_by, *rest), place).alias("_latest")
    else:
        latest = F.max(F.struct(*order_by, *rest)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*[
        F.col(c) if c in keys else F.col(f"_latest.`{c}`").alias(c) for c in df.columns
    ])


def _has_map(kind: T.DataType) -> bool:
    """Whether values of a type cannot be ordered."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType | T.VariantType)


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def merge_rows(
    core: DataFrame, staged: DataFrame, keys: Sequence[str], known: KeyFilter | None = None
) -> DataFrame:
    """Core rows without a staged match, and all staged rows. A null key matches nothing.

    With a filter of many staged keys only core rows that may match are joined; the others stay where
    they were read.
    """
    wanted = staged.select(*keys)
    if known is None or known.words is None:
        kept = core.join(wanted, list(keys), "left_anti").select(*core.columns)
        return kept.unionByName(staged.select(*core.columns))
    kept = known.narrow(core).join(wanted, list(keys), "left_anti").select(*core.columns)
    return core.filter(~known.may_match()).unionByName(kept).unionByName(staged.select(*core.columns))


def staged_for_merge(
    staged: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None
) -> DataFrame:
    """One staged row per key, the latest one; rows with a null key all stay."""
    if not order_by:
        return staged
    present = _all_present(keys)
    return latest_per_key(staged.filter(present), keys, order_by).unionByName(
        staged.filter(~present)
    )


def publish_merge(
    spark: SparkSession,
    core: str,
    staging: str | DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep_old: bool = False,
    ctx: RunContext | None = None,
    keys_stay: bool = False,
    filter_from: int = FILTER_FROM,
) -> MergeResult:
    """Merge staged rows into the core table by key: replace matches, add the rest.

    `order_by` picks the latest of several staged rows of a key; without it staged keys that occur
    twice raise. A partitioned core table is rewritten only in the partitions that lose or gain rows,
    an unpartitioned one as a whole; `keep_old` then leaves the former files in place. Staged rows
    without the load columns that the core table has become rows of the load `ctx`. With `keys_stay`
    the caller says that a key never changes its partition, and only partitions of staged rows are
    read; otherwise matches are looked for in the whole core table, whose scan takes the keys alone and
    drops rows outside the ranges and the Bloom filter of the staged keys before anything is shuffled.
    """
    written = isinstance(staging, str)
    staging = spark.table(staging) if written else staging
    if ctx and set(LOAD_COLUMNS) <= set(spark.table(core).columns) - set(staging.columns):
        staging = with_context(staging, ctx)
    if not order_by:
        twice = staging.filter(_all_present(keys)).groupBy(*keys).count().filter("count > 1")
        if found := twice.select(*keys).head(3):
            raise DuplicateKeys(f"staged keys occur more than once, such as {[tuple(r) for r in found]}")
        if written:
            return _merge(spark, core, staging, keys, keep_old, keys_stay, filter_from)
    # Written once: read for the join and for the insert, and of known size for the planner.
    with materialised(staged_for_merge(staging, keys, order_by), "merge") as staged:
        return _merge(spark, core, staged, keys, keep_old, keys_stay, filter_from)


def _merge(
    spark: SparkSession,
    core: str,
    staged: DataFrame,
    keys: Sequence[str],
    keep_old: bool,
    keys_stay: bool,
    filter_from: int,
) -> MergeResult:
    partitions, before = partition_columns(spark, core), spark.table(core)
    known = key_filter(staged, keys, before.schema, filter_from)
    if partitions:
        return _merge_partitions(spark, core, staged, keys, partitions, keys_stay, known)
    old_rows = before.count()  # no column is read: file footers hold the counts
    new_rows = replace_rows(spark, core, merge_rows(before, staged, keys, known), keep_old)
    return _merge_result(old_rows, new_rows, staged)


def _merge_result(old_rows: int, new_rows: int, staged: DataFrame) -> MergeResult:
    staged_rows = staged.count()
    updated = old_rows + staged_rows - new_rows
    return MergeResult(updated, staged_rows - updated)


def _merge_partitions(
    spark: SparkSession,
    core: str,
    staged: DataFrame,
    keys: Sequence[str],
    partitions: list[str],
    keys_stay: bool,
    known: KeyFilter,
) -> MergeResult:
    before = spark.table(core)
    touched = staged.select(*partitions)
    keys_can_move = not keys_stay and not set(partitions) <= set(keys)
    if keys_can_move:
        matched = matched_rows(before, staged, keys, known)
        touched = touched.unionByName(matched.select(*partitions))
    with materialised(touched.distinct(), "touched") as touched:
        affected = in_partitions(before, touched, partitions)
        old_rows = affected.count()
        # The join runs once; what it gives is read for the emptied partitions and the overwrite.
        with materialised(merge_rows(affected, staged, keys, known), "merged") as merged:
            rewrite_partitions(spark, core, merged, touched, partitions, can_empty=keys_can_move)
            return _merge_result(old_rows, merged.count(), staged)


def matched_rows(
    core: DataFrame, staged: DataFrame, keys: Sequence[str], known: KeyFilter
) -> DataFrame:
    """Core rows with a staged match."""
    return known.narrow(core).join(staged.select(*keys), list(keys), "left_semi")


def in_partitions(df: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The rows of the given partitions.

    The scan is told the values of each partition column, so that other folders are not opened; the
    catalog lists partitions in the driver anyway. With several columns a join takes out combinations
    that were not given.
    """
    wanted = F.lit(True)
    for name in partitions:
        values = [row[name] for row in touched.select(name).distinct().collect()]
        given = [F.lit(v).cast(df.schema[name].dataType) for v in values if v is not None]
        named = F.col(name).isin(given) if given else F.lit(False)
        wanted = wanted & (named if len(given) == len(values) else named | F.col(name).isNull())
    pruned = df.filter(wanted)
    if len(partitions) == 1:
        return pruned
    same = same_values("d", "t", partitions)
    return pruned.alias("d").join(touched.alias("t"), same, "left_semi")


def rewrite_partitions(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    touched: DataFrame,
    partitions: list[str],
    can_empty: bool,
) -> None:
    """Overwrite the touched partitions with `rows` and drop those that are left without any.

    The rebalance gathers each partition into few files and splits partitions that hold many rows.
    The overwrite is one commit; partitions are dropped after it, and doing it all again is safe.
    """
    emptied = []
    if can_empty:
        filled = rows.select(*partitions).distinct().alias("f")
        same = same_values("t", "f", partitions)
        emptied = touched.alias("t").join(filled, same, "left_anti").collect()
    ordered = rows.select(*spark.table(table).columns).hint("rebalance", *partitions)
    with setting(rows.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ordered.write.insertInto(table, overwrite=True)
    for row in emptied:
        drop_partition(spark, table, {p: row[p] for p in partitions})
    spark.catalog.refreshTable(table)


def drop_partition(spark: SparkSession, table: str, values: Mapping[str, object]) -> None:
    """Drop a partition with its files; no row is read."""
    quoted = {
        k: "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        for k, v in values.items()
    }
    spec = ", ".join(f"`{k}` = {v}" for k, v in quoted.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def replace_rows(
    spark: SparkSession, table: str, df: DataFrame, keep_old: bool = False
) -> int:
    """Give an unpartitioned table new content, which may be computed from the old one.

    The rows are written through a table like this one, so in its own format with its options, to a
    new folder; they are read back and counted before the folder becomes the table's, and the former
    one is deleted last, unless `keep_old` leaves it for queries that still read it. Returns the
    number of rows.
    """
    old = table_location(spark, table)
    root = re.sub(r"--[0-9a-f]{32}/?$", "", old.rstrip("/"))
    mark = uuid.uuid4().hex
    new, like = f"{root}--{mark}", f"{table}_{mark}"
    spark.sql(f"CREATE TABLE {like} LIKE {table} LOCATION '{new}'")
    try:
        names = ", ".join(f"`{c}`" for c in spark.table(table).columns)
        spark.sql(f"INSERT INTO {like} ({names}) SELECT {names} FROM {{rows}}", rows=df)
        rows = spark.table(like).count()
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    except Exception:
        discard(spark, new)
        raise
    finally:
        spark.sql(f"DROP TABLE {like}")
    spark.catalog.refreshTable(table)
    if not keep_old:
        discard(spark, old)
    return rows


def load_rows(ctx: RunContext) -> Column:
    """A filter on the rows of one load; partition values on a core table made by `create_core`."""
    return (F.col(TABLE_ID) == ctx.table_id) & (F.col(COMMIT_EPOCH) == ctx.commit_epoch)


def other_rows(ctx: RunContext) -> Column:
    """A filter on all rows but those of one load, rows that belong to no load included."""
    return ~F.coalesce(load_rows(ctx), F.lit(False))


def loaded_rows(df: DataFrame, ctx: RunContext) -> DataFrame:
    """The rows that the current load brought in."""
    return df.filter(load_rows(ctx))


def purge(spark: SparkSession, table: str, ctx: RunContext) -> int:
    """Delete the rows of one load once ELT is done with them; return how many.

    A table partitioned by load drops the partition (whose files stay if the table is external).
    Any other table is rewritten without the rows, in the partitions that hold some of them.
    """
    partitions = partition_columns(spark, table)
    before = spark.table(table)
    if set(LOAD_COLUMNS) == set(partitions):
        rows = loaded_rows(before, ctx).count()
        drop_partition(spark, table, {TABLE_ID: ctx.table_id, COMMIT_EPOCH: ctx.commit_epoch})
        return rows
    rows = before.count()
    if not partitions:
        return rows - replace_rows(spark, table, before.filter(other_rows(ctx)))
    else:
        touched = loaded_rows(before, ctx).select(*partitions).distinct()
        with materialised(touched, "touched") as touched:
            kept = in_partitions(before, touched, partitions).filter(other_rows(ctx))
            rewrite_partitions(spark, table, kept, touched, partitions, can_empty=True)
    return rows - spark.table(table).count()


def drop_staging(spark: SparkSession, name: str, ctx: RunContext) -> None:
    """Drop the staging table of a load; `name` may hold placeholders."""
    spark.sql(f"DROP TABLE IF EXISTS {ctx.evaluate(name)}")


def rollup(
    df: DataFrame,
    ts: str,
    every: str,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    watermark: str | None = None,
) -> DataFrame:
    """Aggregate a time series per interval and key; the interval's start is `bucket`.

    A stream gives a `watermark`, after which an interval is final.
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    grouped = df.groupBy(F.window(ts, every).alias("_window"), *keys)
    aggregated = grouped.agg(*[agg.alias(name) for name, agg in aggs.items()])
    return aggregated.select(F.col("_window.start").alias("bucket"), *keys, *aggs)
