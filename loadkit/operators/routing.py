"""Routing: good rows, failed units, and rows for different targets."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.operators.binding import ERROR
from loadkit.session import materialise, same_values, scratch_path, setting
from loadkit.sources.records import UNIT

UNIT_POLICY = "unit"
ROW_POLICY = "row"
_FOLDER = "_route"


def split_bad(
    df: DataFrame,
    policy: str = UNIT_POLICY,
    unit: Sequence[str] = (UNIT,),
    error: str = ERROR,
) -> tuple[DataFrame, DataFrame]:
    """Split rows into those to load and those that failed; together they are the input.

    `row` keeps the good rows of a unit. `unit` fails all rows of a unit that has a bad one. `df`
    should be landed or otherwise cheap to read twice. The failed units are written first: the
    planner then knows their size and broadcasts them only when they are few.
    """
    is_bad = F.col(error).isNotNull()
    if policy == ROW_POLICY:
        return df.filter(~is_bad), df.filter(is_bad)
    if policy != UNIT_POLICY:
        raise ValueError(f"unknown failure policy {policy!r}")
    failed = materialise(df.filter(is_bad).select(*unit).distinct(), "failed_units")
    same = same_values("d", "f", unit)
    rows, failed = df.alias("d"), failed.alias("f")
    return rows.join(failed, same, "left_anti"), rows.join(failed, same, "left_semi")


@dataclass(frozen=True)
class LandedRoutes:
    """Rows in a folder per route. The route is also a column of the files: a folder name cannot
    tell null from empty text."""

    path: str
    schema: T.StructType
    on: str

    def read(self, spark: SparkSession) -> DataFrame:
        folder = T.StructField(_FOLDER, T.StringType())
        return spark.read.schema(T.StructType([*self.schema.fields, folder])).parquet(self.path)

    def _folders(self, spark: SparkSession, keys: Sequence) -> list[str | None]:
        """Named by the cast that named the folders, so that any type of key finds its own."""
        kind = self.schema[self.on].dataType
        names = [F.lit(k).cast(kind).cast("string") for k in keys]
        return spark.range(1).select(F.array(*names)).first()[0] if keys else []

    def sizes(self, spark: SparkSession, keys: Sequence) -> dict:
        """The bytes that were written for each of the given routes; no file is opened.

        Null and empty text share a folder, so each has the bytes of both.
        """
        infer = "spark.sql.sources.partitionColumnTypeInference.enabled"
        with setting(spark, infer, "false"):
            files = spark.read.format("binaryFile").load(self.path)
        if _FOLDER not in files.columns:
            return dict.fromkeys(keys, 0)
        folders = self._folders(spark, keys)
        wanted = F.col(_FOLDER).isin([f for f in folders if f]) | F.col(_FOLDER).isNull()
        found = files.filter(wanted).groupBy(_FOLDER).agg(F.sum("length").alias("size"))
        by_folder = {row[_FOLDER]: row["size"] for row in found.collect()}
        return {k: by_folder.get(f or None, 0) for k, f in zip(keys, folders, strict=True)}

    def rows(self, spark: SparkSession, keys: Sequence) -> DataFrame:
        """The rows of the given routes; no other folder is opened."""
        if not keys:
            return self.read(spark).limit(0).drop(_FOLDER)
        kind = self.schema[self.on].dataType
        folders = [name for name in self._folders(spark, keys) if name]
        folder = F.col(_FOLDER).isin(folders)
        if len(folders) < len(keys):
            folder = folder | F.col(_FOLDER).isNull()
        same = F.col(self.on).isin([F.lit(k).cast(kind) for k in keys])
        return self.read(spark).filter(folder & same).drop(_FOLDER)

    def rest(self, spark: SparkSession, keys: Sequence) -> DataFrame:
        """The rows of all other routes, and those without a route."""
        kind = self.schema[self.on].dataType
        same = [F.lit(k).cast(kind) for k in keys]
        known = F.coalesce(F.col(self.on).isin(same), F.lit(False)) if keys else F.lit(False)
        return self.read(spark).filter(~known).drop(_FOLDER)


def land_routes(df: DataFrame, on: str, gather: bool = False) -> LandedRoutes:
    """Write rows once into a folder per route.

    Every task writes a file per route, without a shuffle. With many routes the files get small;
    `gather` shuffles rows by route first, and splits routes that hold many rows.
    """
    path = scratch_path(df.sparkSession, "routes")
    foldered = df.withColumn(_FOLDER, F.col(on).cast("string"))
    if gather:
        foldered = foldered.hint("rebalance", _FOLDER)
    foldered.write.partitionBy(_FOLDER).parquet(path)
    return LandedRoutes(path, df.schema, on)


def read_control(control: DataFrame, on: str) -> list[Row]:
    """The rows of a control table: configuration of a row per route, which the driver acts on."""
    rows = control.collect()
    for key, times in Counter(row[on] for row in rows).items():
        if times > 1:
            raise ValueError(f"route {key!r} is given {times} times")
    return rows


def route(
    df: DataFrame, control: DataFrame, on: str, gather: bool = False
) -> dict[str | None, DataFrame]:
    """The rows for each target named in the control table, and under `None` those without one.

    `control` has a row per route with at least the columns `on` and `target`.
    """
    spark, landed = df.sparkSession, land_routes(df, on, gather)
    routes: dict[str, list] = {}
    for row in read_control(control, on):
        routes.setdefault(row["target"], []).append(row[on])
    targets: dict[str | None, DataFrame] = {t: landed.rows(spark, k) for t, k in routes.items()}
    targets[None] = landed.rest(spark, [key for keys in routes.values() for key in keys])
    return targets


def with_control(df: DataFrame, control: DataFrame, on: str) -> DataFrame:
    """Give every row the settings of its route; rows without a route keep nulls."""
    return df.join(control, on, "left")
