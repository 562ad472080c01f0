"""Loading a unit: staging, landing with a row count, and publishing.

A core table made by `create_core` is partitioned by the load (`TABLE_ID`, `COMMIT_EPOCH`). A load
writes its files to a folder of its own; nothing is visible until the folder is attached as a
partition. That makes a publish one change in the catalog: it copies no rows, it either happens or
does not, and the same load cannot be published twice.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext, TableIdInUse
from loadkit.operators.binding import DEFAULT_KEY, ERROR, TEXT_TYPE_KEY, bind_by_name, strict
from loadkit.operators.units import load_context, unit_counts
from loadkit.session import TableFacts, discard, table_location, table_provider
from loadkit.sources.delimited import read_delimited
from loadkit.sources.records import MALFORMED, UNIT, UNIT_SIZE, SchemaMissing

LOAD_COLUMNS = (TABLE_ID, COMMIT_EPOCH)
SELF_DESCRIBING = ("parquet", "orc", "json", "avro")
STAGING_NAME = f"stg_%{TABLE_ID}%_%{COMMIT_EPOCH}%"


def now_millis() -> int:
    return time.time_ns() // 1_000_000


@dataclass(frozen=True)
class LoadResult:
    """What a load wrote and how long it took; `bad` counts the rows with an error."""

    rows: int
    start: int
    stop: int
    bad: int = 0
    location: str | None = None
    provider: str = "parquet"


def columns_ddl(schema: T.StructType) -> str:
    """The columns as they were declared: text lengths, NOT NULL and defaults included."""

    def column(field: T.StructField) -> str:
        told = field.metadata or {}
        text = f"`{field.name}` {told.get(TEXT_TYPE_KEY) or field.dataType.simpleString()}"
        text += "" if field.nullable else " NOT NULL"
        return text + (f" DEFAULT {told[DEFAULT_KEY]}" if DEFAULT_KEY in told else "")

    return ", ".join(map(column, schema.fields))


def create_core(
    spark: SparkSession, table: str, schema: T.StructType, location: str | None = None
) -> None:
    """Create a core table that is partitioned by load."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE {table} ({columns_ddl(schema)}, {TABLE_ID} STRING, {COMMIT_EPOCH} INT) "
        f"USING parquet PARTITIONED BY ({TABLE_ID}, {COMMIT_EPOCH}){place}"
    )


def core_schema(spark: SparkSession, table: str) -> T.StructType:
    """The columns a load has to fill: those of the table without the load columns."""
    return T.StructType([f for f in spark.table(table).schema.fields if f.name not in LOAD_COLUMNS])


def create_staging(spark: SparkSession, target: str, name: str, ctx: RunContext) -> str:
    """Create an empty staging table like the target; raises when the name is in use.

    `name` may hold placeholders. Column defaults of the target are kept.
    """
    staging = ctx.evaluate(name)
    spark.sql(f"CREATE TABLE {staging} LIKE {target}")
    return staging


def load_batch(df: DataFrame, table: str) -> LoadResult:
    """Append a bound frame to a table in one job and count the rows on the way.

    Columns go to those of the same name, in any order; the table's defaults fill the ones that the
    frame lacks. The append is committed as a whole or not at all. The rows are counted in the
    writing stage, whose tasks each report once however often they are retried.
    """
    spark = df.sparkSession
    start = now_millis()
    written = Observation("load")
    observed = df.observe(written, F.count(F.lit(1)).alias("rows"))
    names = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{rows}}", rows=observed)
    return LoadResult(written.get["rows"], start, now_millis())


def load_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    sep: str = "|",
    charset: str = "UTF-8",
    mixed: bool = False,
) -> LoadResult:
    """Bulk load delimited files whose header names columns of the table; `mixed` if headers differ.

    Read, cast and written in one pass. Any malformed record or failed cast fails the job, which
    leaves the table as it was.
    """
    text = read_delimited(spark, paths, sep, charset, mixed=mixed)
    target = spark.table(table).schema
    added = (UNIT, UNIT_SIZE, MALFORMED)
    unknown = [c for c in text.columns if c not in added and c not in target.fieldNames()]
    if unknown:
        raise SchemaMissing(f"{table} has no columns {unknown}")
    return load_batch(strict(bind_by_name(text, target, on_absent="default", errors=True)), table)


class BadRecords(ValueError):
    """A load was given records it cannot load; `landing` holds all of them with their errors."""

    def __init__(self, landing: LoadResult):
        super().__init__(f"{landing.bad} of {landing.rows} records are bad, see {landing.location}")
        self.landing = landing


def land(df: DataFrame, location: str, provider: str = "parquet") -> LoadResult:
    """Write bound rows to a folder; good and bad rows are counted on the way.

    The source is parsed and cast once. Whatever follows reads the columns it needs from here.
    """
    start = now_millis()
    counts = Observation("landing")
    wanted = [F.count(F.lit(1)).alias("rows")]
    if ERROR in df.columns:
        wanted.append(F.count(F.col(ERROR)).alias("bad"))
    df.observe(counts, *wanted).write.format(provider).save(location)
    found = counts.get
    return LoadResult(found["rows"], start, now_millis(), found.get("bad", 0), location, provider)


def landed_rows(spark: SparkSession, landed: LoadResult, schema: T.StructType) -> DataFrame:
    """Read the given columns of a landing back."""
    return spark.read.schema(schema).format(landed.provider).load(landed.location)


def load_location(
    spark: SparkSession, core: str, ctx: RunContext, part: str = "", root: str | None = None
) -> str:
    """Where the files of a load go: below the core table, in a folder that only the partition of
    the load will point to. Its name keeps a repair of the table's partitions from finding it, and
    each attempt at a load has its own."""
    attempt = uuid.uuid4().hex[:12]
    return f"{root or table_location(spark, core)}/_loads/{ctx.table_id}/{ctx.commit_epoch}{part}-{attempt}"


def attaches(facts: TableFacts) -> bool:
    """Whether a load becomes a partition of this table: it is partitioned by load, in files that
    name their columns."""
    return set(LOAD_COLUMNS) <= set(facts.partitions) and facts.provider in SELF_DESCRIBING


def publish_attach(spark: SparkSession, core: str, location: str, ctx: RunContext) -> None:
    """Make a written folder the partition of its load; raises if that load is already published."""
    spark.sql(
        f"ALTER TABLE {core} ADD PARTITION ({TABLE_ID} = '{ctx.table_id}', "
        f"{COMMIT_EPOCH} = {ctx.commit_epoch}) LOCATION '{location}'"
    )


def is_published(spark: SparkSession, core: str, ctx: RunContext) -> bool:
    """Whether the partition of this load exists; reads the catalog only."""
    shown = spark.sql(
        f"SHOW PARTITIONS {core} PARTITION ({TABLE_ID} = '{ctx.table_id}', "
        f"{COMMIT_EPOCH} = {ctx.commit_epoch})"
    )
    return not shown.isEmpty()


def published_loads(spark: SparkSession, core: str, table_ids: Sequence[str]) -> DataFrame:
    """TABLE_ID and COMMIT_EPOCH of the partitions that the given runs have in a core table.

    The catalog is asked for these runs alone; no other partition is listed.
    """
    found = []
    for table_id in table_ids:
        shown = spark.sql(f"SHOW PARTITIONS {core} PARTITION ({TABLE_ID} = '{table_id}')").collect()
        epochs = (dict(p.split("=") for p in row["partition"].split("/")) for row in shown)
        found += [(table_id, int({k.upper(): v for k, v in e.items()}[COMMIT_EPOCH])) for e in epochs]
    return spark.createDataFrame(found, f"{TABLE_ID} string, {COMMIT_EPOCH} int")


def load_staged(
    df: DataFrame,
    core: str,
    ctx: RunContext,
    check: Callable[[DataFrame], None] | None = None,
) -> LoadResult:
    """Load a bound frame into a core table partitioned by load: write, check, attach.

    An error on the way leaves the core table unchanged, and the load can be tried again. What was
    written is deleted, unless it holds bad records to look at.
    """
    spark = df.sparkSession
    location = load_location(spark, core, ctx)
    try:
        landed = land(df, location, table_provider(spark, core))
        if landed.bad:
            raise BadRecords(landed)
        if check:
            check(landed_rows(spark, landed, core_schema(spark, core)))
        publish_attach(spark, core, landed.location, ctx)
    except BadRecords:
        raise
    except Exception:
        discard(spark, location)
        raise
    return landed


def load_many(
    df: DataFrame, units: Sequence[str], core: str, ctx: RunContext, gather: bool = True
) -> DataFrame:
    """Load the units of a frame in one job, each under an epoch of its own; return their counts.

    The job for a large number of small units: its cost depends on the rows and not on the number of
    units. All files are written before any unit is visible; the partitions are then added in as few
    catalog calls as the catalog allows. `gather` shuffles rows so that a unit has few files, and
    splits units that hold many rows; without it every task writes a file for each unit it has. The
    counts come from file footers.

    Raises when epochs of this run, from its current one on, are in the table already.
    """
    spark = df.sparkSession
    taken = spark.sql(f"SHOW PARTITIONS {core} PARTITION ({TABLE_ID} = '{ctx.table_id}')")
    epoch = F.substring_index("partition", "=", -1).cast("int")
    if not taken.filter(epoch >= ctx.commit_epoch).isEmpty():
        raise TableIdInUse(f"loads of {ctx.table_id} from {ctx.commit_epoch} on are in {core}")
    stamped = load_context(df, units, ctx).select(*spark.table(core).columns)
    if gather:
        stamped = stamped.hint("rebalance", COMMIT_EPOCH)
    stamped.write.insertInto(core)
    of_run = (F.col(TABLE_ID) == ctx.table_id) & (F.col(COMMIT_EPOCH) >= ctx.commit_epoch)
    loaded = spark.table(core).filter(of_run)
    return unit_counts(loaded, [TABLE_ID, COMMIT_EPOCH])
