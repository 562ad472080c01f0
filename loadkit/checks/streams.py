"""Streams of units, and replay."""

from __future__ import annotations

from contextlib import suppress
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from loadkit.checks import query, table, workspace
from loadkit.context import RunContext
from loadkit.operators.loading import LOAD_COLUMNS, create_core
from loadkit.operators.units import plan_units
from loadkit.plans.run import LoadSpec, file_units, open_run, run_load
from loadkit.session import scratch_path
from loadkit.sources.records import list_units, read_records, read_unit_stream
from loadkit.streaming.drain import create_ledger, drain, load_unpublished, run_stream

EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value FROM events"
# A bound timestamp keeps milliseconds.
BOUND_EVENTS_SQL = EVENTS_SQL.replace(" ts,", " date_trunc('millisecond', ts) AS ts,")
FILES = 6


class Stopped(Exception):
    """Ends a run half-way."""


def _event_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The events as a queue of files."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    path = scratch_path(spark, "queue")
    events.repartition(FILES, "event_id").write.parquet(path)
    return path, events


@query(EVENTS_SQL)
def stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain a queue of files, two at a time, then stop."""
    path, events = _event_files(spark, sf_dir)
    landing = scratch_path(spark, "drained")
    stream = read_unit_stream(spark, path, "parquet", events.schema, max_files=2)
    drain(stream, landing, scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(landing).select(*events.columns)


@query(BOUND_EVENTS_SQL)
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch goes through the load sequence; a second call finds nothing to do."""
    db = workspace(spark)
    path, events = _event_files(spark, sf_dir)
    create_core(spark, f"{db}.core", events.schema)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = read_unit_stream(spark, path, "parquet", events.schema, max_files=3)
        spec = LoadSpec(target=f"{db}.core", fields=events.columns)
        run_stream(spark, stream, spec, "events", landing, checkpoint, f"{db}.ledger")
    return spark.table(f"{db}.core").drop(*LOAD_COLUMNS)


@query(BOUND_EVENTS_SQL)
def replay_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run stops half-way; the next ones are given all units again, and each is loaded once."""
    db = workspace(spark)
    path, events = _event_files(spark, sf_dir)
    create_core(spark, f"{db}.core", events.schema)
    create_ledger(spark, f"{db}.ledger")
    spec = LoadSpec(target=f"{db}.core", fields=events.columns)
    listing = list_units(spark, path, "*.parquet")

    def read(session: SparkSession, paths: list[str]) -> DataFrame:
        return read_records(session, paths, "parquet", events.schema)

    def stop(_: SparkSession, ctx: RunContext) -> None:
        if ctx.commit_epoch == FILES // 2:
            raise Stopped

    stopping = replace(spec, before_publish=[stop])
    with suppress(Stopped), open_run(spark) as run:
        load_unpublished(run, listing, read, stopping, f"{db}.ledger", "events")
    for _ in range(2):
        with open_run(spark) as run:
            load_unpublished(run, listing, read, spec, f"{db}.ledger", "events")
    return spark.table(f"{db}.core").drop(*LOAD_COLUMNS)


@query("SELECT event_id, user_id, value FROM events")
def load_binned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files are merged into larger units by size and loaded in one run."""
    db = workspace(spark)
    path, events = _event_files(spark, sf_dir)
    fields = ["event_id", "user_id", "value"]
    create_core(spark, f"{db}.core", events.select(*fields).schema)
    spec = LoadSpec(target=f"{db}.core", fields=fields)
    listing = list_units(spark, path, "*.parquet")

    def read(session: SparkSession, paths: list[str]) -> DataFrame:
        return read_records(session, paths, "parquet", events.schema)

    run_load(spark, file_units(plan_units(listing, target_bytes=200_000), read), spec)
    return spark.table(f"{db}.core").drop(*LOAD_COLUMNS)
