"""A roll-up that follows its core table load by load.

The roll-up table holds partial aggregates per interval, key and load, in a partition per load like the
core table. A new load adds its partition, read from its own rows; a purged load loses it again. Neither
reads the series of other loads. Reading the roll-up merges the partial aggregates.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.context import RunContext
from loadkit.operators.elt import drop_partition, loaded_rows, rollup
from loadkit.operators.loading import (
    LOAD_COLUMNS,
    create_core,
    is_published,
    load_staged,
)

#: How a value is aggregated over rows, and partial values over loads.
_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_SPEC = "loadkit.rollup"


@dataclass(frozen=True)
class RollupSpec:
    """What a roll-up table holds: the time column, the interval, the keys, and per output column a
    kind (`count`, `sum`, `min`, `max`, `avg`) with the SQL expression it is of."""

    ts: str
    every: str
    keys: Sequence[str]
    values: Mapping[str, Sequence[str]]

    def partial(self) -> dict[str, Column]:
        """The columns that are kept; an average is kept as a sum and a count."""
        out = {}
        for name, (kind, of) in self.values.items():
            if kind == "avg":
                out[f"{name}_sum"], out[f"{name}_count"] = F.sum(F.expr(of)), F.count(F.expr(of))
            else:
                out[name] = _PARTIAL[kind](F.expr(of))
        return out

    def merged(self) -> dict[str, Column]:
        out = {}
        for name, (kind, _) in self.values.items():
            if kind == "avg":
                out[name] = F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))
            else:
                out[name] = _MERGE[kind](name)
        return out


def create_rollup(spark: SparkSession, table: str, core: str, spec: RollupSpec) -> None:
    """Create the roll-up table of a core table; it remembers its spec."""
    unknown = {kind for kind, _ in spec.values.values()} - {*_PARTIAL, "avg"}
    if unknown:
        raise ValueError(f"no partial aggregates for {sorted(unknown)}")
    create_core(spark, table, _partial_rows(spark.table(core), spec).schema)
    told = json.dumps(asdict(spec)).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_SPEC}' = '{told}')")


def rollup_spec(spark: SparkSession, table: str) -> RollupSpec:
    """The spec that a roll-up table was created with."""
    (row,) = spark.sql(f"SHOW TBLPROPERTIES {table} ('{_SPEC}')").collect()
    return RollupSpec(**json.loads(row["value"]))


def _partial_rows(rows: DataFrame, spec: RollupSpec) -> DataFrame:
    return rollup(rows, spec.ts, spec.every, spec.keys, spec.partial())


def add_load(spark: SparkSession, table: str, core: str, ctx: RunContext) -> int:
    """Roll up the rows of one load of the core table; a load that is there already is left alone.

    Returns the rows added. Only the partition of the load is read.
    """
    if is_published(spark, table, ctx):
        return 0
    rows = _partial_rows(loaded_rows(spark.table(core), ctx), rollup_spec(spark, table))
    return load_staged(rows, table, ctx).rows


def take_out(spark: SparkSession, table: str, ctx: RunContext) -> None:
    """Undo `add_load` for a load that is purged from the core table; no row is read."""
    drop_partition(spark, table, dict(zip(LOAD_COLUMNS, (ctx.table_id, ctx.commit_epoch), strict=True)))


def missing_loads(spark: SparkSession, table: str, core: str) -> DataFrame:
    """The loads of the core table that the roll-up lacks, by the catalog alone."""
    one, two = (spark.sql(f"SHOW PARTITIONS {name}") for name in (core, table))
    return one.join(two, "partition", "left_anti")


def rolled_up(spark: SparkSession, table: str) -> DataFrame:
    """The roll-up: bucket, keys, and the values over all loads that are in it."""
    spec = rollup_spec(spark, table)
    merged = [value.alias(name) for name, value in spec.merged().items()]
    return spark.table(table).groupBy("bucket", *spec.keys).agg(*merged)
