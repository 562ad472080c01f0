"""Streams of units: drain what waits, load it batch by batch, and load nothing twice.

The stream itself only lands typed records in files, one folder per micro-batch; the file sink and
the checkpoint make that exactly-once, also after a failure. The sink's own log says which files a
batch has. The load sequence then runs over each batch that the ledger does not know as published, and
deletes its files behind it.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext
from loadkit.operators.loading import published_loads
from loadkit.operators.units import plan_units
from loadkit.plans.run import LoadSpec, Run, Unit, file_units, open_run
from loadkit.session import discard, materialise, setting
from loadkit.sources.records import UNIT, UNIT_SIZE

BATCH = "_batch"
#: The state of a ledger entry: a load that was to come, and one that is known to be visible.
NOTED, PUBLISHED = "noted", "published"
#: Where a file sink keeps its log, and what a line of it says.
SINK_LOG, LOG_ENTRY = "_spark_metadata", "path string, size bigint, action string"


def drain(stream: DataFrame, landing: str, checkpoint: str) -> StreamingQuery:
    """Land every waiting unit, then stop.

    The folder of a micro-batch is named by its time, which the checkpoint keeps: a batch that runs
    again after a failure gets the same name.
    """
    named = stream.withColumn(BATCH, F.unix_millis(F.current_timestamp()).cast("string"))
    query = (
        named.writeStream.format("parquet")
        .option("path", landing)
        .option("checkpointLocation", checkpoint)
        .partitionBy(BATCH)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def create_ledger(spark: SparkSession, ledger: str) -> None:
    """A table of the units whose load was started, by the load that did it, and of those published.

    It is partitioned by stream, so that a stream reads its own entries only.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {ledger} ({UNIT} STRING, {TABLE_ID} STRING, "
        f"{COMMIT_EPOCH} INT, state STRING, stream STRING) USING parquet PARTITIONED BY (stream)"
    )


def note_units(
    ledger: str, units: DataFrame, name: str, ctx: RunContext, state: str = NOTED
) -> None:
    """Enter units into the ledger: before any of their loads is published, or behind that.

    `units` has the unit and `unit_no`, which counts the loads of the run that are to come.
    """
    entries = units.select(
        F.col(UNIT),
        F.lit(ctx.table_id).alias(TABLE_ID),
        (F.col("unit_no") + F.lit(ctx.commit_epoch)).cast("int").alias(COMMIT_EPOCH),
        F.lit(state).alias("state"),
        F.lit(name).alias("stream"),
    )
    # Gathered into files as large as their number of rows asks for.
    entries.hint("rebalance").write.insertInto(ledger)


def published_units(
    spark: SparkSession, ledger: str, core: str, name: str, waiting: DataFrame | None = None
) -> DataFrame:
    """The units of a stream that are visible in the core table; of `waiting` ones, if they are given.

    An entry alone is only an intention. A run enters what it has published when it ends; of a run that
    died before that, the partitions in the core table tell, and only those of such runs are looked up.
    """
    entries = spark.table(ledger).filter(F.col("stream") == name)
    if waiting is not None:
        entries = entries.join(waiting.select(UNIT), UNIT, "left_semi")
    known = entries.filter(F.col("state") == PUBLISHED).select(UNIT)
    return known.unionByName(_unconfirmed(spark, entries, core).select(UNIT)).distinct()


def _unconfirmed(spark: SparkSession, entries: DataFrame, core: str) -> DataFrame:
    """Entries of runs that died between publishing and saying so."""
    known = entries.filter(F.col("state") == PUBLISHED).select(UNIT)
    open_units = entries.filter(F.col("state") == NOTED).join(known, UNIT, "left_anti")
    # A row per run that has not said how its loads ended; runs that ended normally have no such rows.
    runs = [row[TABLE_ID] for row in open_units.select(TABLE_ID).distinct().collect()]
    visible = published_loads(spark, core, runs)
    return open_units.join(visible, [TABLE_ID, COMMIT_EPOCH], "left_semi")


def unpublished(
    spark: SparkSession, units: DataFrame, ledger: str, core: str, name: str
) -> DataFrame:
    """Rows whose unit is not yet published; replayed units drop out."""
    return units.join(published_units(spark, ledger, core, name, units), UNIT, "left_anti")


def compact_ledger(spark: SparkSession, ledger: str, core: str, name: str) -> None:
    """Rewrite the entries of a stream: one for every unit that is published, none for the others.

    Loads of the stream must not run meanwhile. Entries of runs that died are settled by the partitions
    of the core table.
    """
    entries = spark.table(ledger).filter(F.col("stream") == name)
    settled = _unconfirmed(spark, entries, core).withColumn("state", F.lit(PUBLISHED))
    every = entries.filter(F.col("state") == PUBLISHED).unionByName(settled)
    one = every.groupBy(UNIT).agg(F.max(F.struct(TABLE_ID, COMMIT_EPOCH)).alias("load"))
    rows = one.select(
        UNIT, f"load.{TABLE_ID}", f"load.{COMMIT_EPOCH}", F.lit(PUBLISHED).alias("state"),
        F.lit(name).alias("stream"),
    )
    written = materialise(rows, "ledger")
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        written.hint("rebalance").write.insertInto(ledger, overwrite=True)
    spark.catalog.refreshTable(ledger)


def load_unpublished(
    run: Run,
    listing: DataFrame,
    read: Callable[[SparkSession, list[str]], DataFrame],
    spec: LoadSpec,
    ledger: str,
    name: str,
    target_bytes: int | None = None,
) -> int:
    """Load the files of a listing that are not yet published; return the number of loads.

    The target must be made by `create_core`. The ledger is read once and written twice per run,
    however many units there are: before the loads, and when they ended, also by an error.
    """
    core, ctx = run.ctx.evaluate(spec.target), run.ctx
    files = listing.select(UNIT, UNIT_SIZE)
    waiting = materialise(unpublished(run.spark, files, ledger, core, name), "waiting")
    if waiting.isEmpty():
        return 0
    planned = plan_units(waiting, target_bytes)
    note_units(ledger, planned.select("unit_no", UNIT), name, ctx)
    loads = 0
    try:
        for unit in file_units(planned, read):
            run.load(unit, spec)
            loads += 1
    finally:
        if loads:
            done = planned.filter(F.col("unit_no") < loads).select("unit_no", UNIT)
            note_units(ledger, done, name, ctx, PUBLISHED)
    return loads


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """The files that a sink has committed, by its log: _batch, path, size. No landed file is opened.

    Compacted parts of the log repeat what came before, so entries are told apart by their paths.
    """
    # File readers leave the log out on purpose; as plain text it is read where it lies.
    text = spark.sparkContext.textFile(f"{landing}/{SINK_LOG}/[0-9]*")
    lines = spark.createDataFrame(text.filter(lambda line: line.startswith("{")).map(lambda line: (line,)), "value string")
    entries = lines.select(F.from_json("value", LOG_ENTRY).alias("e")).select("e.*")
    added = entries.filter("action = 'add'").select("path", "size").distinct()
    return added.select(F.regexp_extract("path", f"/{BATCH}=([^/]*)/", 1).alias(BATCH), "path", "size")


def run_stream(
    spark: SparkSession,
    stream: DataFrame,
    spec: LoadSpec,
    name: str,
    landing: str,
    checkpoint: str,
    ledger: str,
    after_connected=None,
    before_disconnecting=None,
    ctx: RunContext | None = None,
    reports_path: str | None = None,
    keep_landed: bool = False,
) -> DataFrame:
    """Drain a stream of units and run the load sequence for each micro-batch; return the reports.

    Calling it again goes on where the last call stopped. The target must be made by `create_core`. The
    files of a batch are deleted when it is published, unless `keep_landed` leaves them; no call opens
    a file of a batch that an earlier one has published. A report's size is that of the landed files.
    Rows keep the file that they came from, so outcomes are by file of the stream. With a
    `reports_path` each report is in that folder as soon as its load is done.
    """
    drain(stream, landing, checkpoint)
    with open_run(spark, after_connected, before_disconnecting, ctx, reports_path) as run:
        create_ledger(run.spark, ledger)
        core, first = run.ctx.evaluate(spec.target), run.ctx
        files = landed_files(run.spark, landing).withColumnRenamed(BATCH, UNIT)
        new = unpublished(run.spark, files, ledger, core, name)
        # A row per landed file that waits; numbering the batches takes no more than these.
        numbered = new.withColumn("unit_no", F.dense_rank().over(Window.orderBy(UNIT)).cast("bigint") - 1)
        waiting = materialise(numbered, "batches")
        batches = waiting.select(UNIT, "unit_no").distinct()
        if not waiting.isEmpty():
            note_units(ledger, batches, name, first)
        loads = 0
        try:
            rows = waiting.orderBy("unit_no", "path").toLocalIterator()
            for batch, of_batch in groupby(rows, key=lambda row: row[UNIT]):
                run.load(_batch_unit(stream.schema, batch, list(of_batch)), spec)
                loads += 1
                if not keep_landed:
                    discard(run.spark, f"{landing}/{BATCH}={batch}")
        finally:
            if loads:
                note_units(ledger, batches.filter(F.col("unit_no") < loads), name, first, PUBLISHED)
    return run.reports()


def _batch_unit(schema: T.StructType, batch: str, files: list[Row]) -> Unit:
    paths = [unquote(row["path"]) for row in files]
    return Unit(
        batch,
        sum(row["size"] for row in files),
        lambda session: session.read.schema(schema).parquet(*paths),
    )
