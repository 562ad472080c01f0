"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "loadkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package relies on: UTC, ANSI casts and adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in `spark.checkpoint.dir`.

    Without it, a hidden folder below the warehouse, which all tables share anyway; never a temporary
    folder of one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.loadkit"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark)}/loadkit/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` to the scratch folder and read it back.

    Cuts the lineage, fixes non-deterministic columns, survives lost executors, and gives later joins
    a size that is measured instead of estimated (so the planner broadcasts only what is small).
    """
    return _write_and_read(df, scratch_path(df.sparkSession, name))


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialised(df: DataFrame, name: str = "step") -> Iterator[DataFrame]:
    """`materialise` for a frame that nothing needs after a block."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _write_and_read(df, path)
    finally:
        discard(df.sparkSession, path)


def same_values(left: str, right: str, names: Sequence[str]) -> Column:
    """A join condition between two aliased frames under which nulls are equal."""
    pairs = [F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names]
    return reduce(lambda a, b: a & b, pairs)


def _found(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _found(spark, path)
    return files.exists(folder)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote and nothing reads any more."""
    files, folder = _found(spark, path)
    files.delete(folder, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Give a session setting another value for the jobs of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def describe(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """What the catalog says about a table, as names and values in sections; runs no job."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return [(row["col_name"], row["data_type"]) for row in rows]


@dataclass(frozen=True)
class TableFacts:
    """The format, the place and the partition columns of a catalog table."""

    provider: str
    location: str
    partitions: list[str]


def table_facts(spark: SparkSession, table: str) -> TableFacts:
    """What loads must know of a table, by one look at the catalog."""
    told = describe(spark, table)
    named = dict(reversed(told))
    return TableFacts(named["Provider"].lower(), named["Location"], _partitions(told))


def table_provider(spark: SparkSession, table: str) -> str:
    """The format of a catalog table's files."""
    return next(value.lower() for name, value in describe(spark, table) if name == "Provider")


def table_location(spark: SparkSession, table: str) -> str:
    """Where the files of a catalog table live."""
    return next(value for name, value in describe(spark, table) if name == "Location")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """The partition columns of a table: the first section after its columns, if there is one."""
    return _partitions(describe(spark, table))


def _partitions(told: list[tuple[str, str]]) -> list[str]:
    names = [name for name, _ in told]
    if "# Partition Information" not in names:
        return []
    section = names[names.index("# Partition Information") + 1 :]
    return [n for n in section[: section.index("")] if not n.startswith("# ")]
