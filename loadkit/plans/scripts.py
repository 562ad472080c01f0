"""Scripts around a load: lists of statements, each with its rows or its update count.

A statement is SQL text with placeholders, or a function of the session and the run context. A
function may return a frame (its rows), a number (its update count) or nothing. A SQL command reports
the rows that its write counted; one that counts none reports no number.

The rows of every result set, whatever their number, are written once as JSON to a folder that the
report names. `result_rows` reads them back.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.context import RunContext, assert_unused
from loadkit.operators.elt import MergeResult, publish_append, publish_merge, purge
from loadkit.operators.loading import LoadResult, now_millis
from loadkit.session import scratch_dir

Statement = str | Callable[[SparkSession, RunContext], Any]

#: Below the scratch folder, by table id.
RESULTS = "loadkit/results"
RESULT_SCHEMA = "location string, row string"


@dataclass
class ResultSet:
    """Where the rows of a statement are, or its update count."""

    update_count: int | None = None
    location: str | None = None

    def as_row(self) -> tuple:
        return (self.update_count, self.location)


@dataclass
class Step:
    """One executed script: when it ran and what its statements returned."""

    name: str
    start: int
    stop: int
    result_sets: list[ResultSet] = field(default_factory=list)


def rows_as_json(df: DataFrame, name: str = "row") -> DataFrame:
    """Every row as a JSON object without its null columns."""
    twice = [c for c, n in Counter(df.columns).items() if n > 1]
    if twice:
        raise ValueError(f"columns {twice} occur more than once in the result set")
    return df.select(F.to_json(F.struct("*")).alias(name))


def write_result(df: DataFrame, ctx: RunContext) -> ResultSet:
    """Run a statement's query once and write its rows to a folder of the run's results."""
    spark = df.sparkSession
    location = f"{scratch_dir(spark)}/{RESULTS}/{ctx.table_id}/{uuid.uuid4().hex}"
    rows_as_json(df).select(F.lit(location).alias("location"), "row").write.parquet(location)
    return ResultSet(location=location)


def result_rows(reports: DataFrame) -> DataFrame:
    """The rows of all result sets in reports: the load, the step, the statement, the row as JSON."""
    spark = reports.sparkSession
    sets = (
        reports.select("attributes.*", F.explode("steps").alias("step"))
        .select(
            "TABLE_ID",
            "COMMIT_EPOCH",
            F.col("step.name").alias("step"),
            F.posexplode("step.resultSets").alias("statement_no", "result"),
        )
        .filter("result.location IS NOT NULL")
        .select("TABLE_ID", "COMMIT_EPOCH", "step", "statement_no", "result.location")
    )
    runs = [r["TABLE_ID"] for r in sets.select("TABLE_ID").distinct().collect()]
    paths = [f"{scratch_dir(spark)}/{RESULTS}/{run}/*" for run in runs]
    rows = spark.read.schema(RESULT_SCHEMA).parquet(*paths) if paths else None
    if rows is None:
        rows = spark.createDataFrame([], RESULT_SCHEMA)
    return sets.join(rows, "location").drop("location")


def written_rows(done: DataFrame) -> int | None:
    """The rows that an executed SQL command wrote, if its plan counted them."""
    plan = done._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() != "CommandResultExec":
        return None
    waiting = [plan.commandPhysicalPlan()]
    while waiting:
        node = waiting.pop()
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined() and "Writ" in node.getClass().getSimpleName():
            return metric.get().value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return None


def _execute(spark: SparkSession, statement: Statement, ctx: RunContext) -> ResultSet:
    done = statement(spark, ctx) if callable(statement) else spark.sql(ctx.evaluate(statement))
    if isinstance(done, DataFrame):
        return write_result(done, ctx) if done.columns else ResultSet(written_rows(done))
    if isinstance(done, MergeResult):
        return ResultSet(done.updated + done.inserted)
    if isinstance(done, LoadResult):
        return ResultSet(done.rows)
    return ResultSet(None if done is None else int(done))


def run_script(
    spark: SparkSession,
    name: str,
    statements: Sequence[Statement] | None,
    ctx: RunContext,
) -> Step | None:
    """Run statements one by one; an empty script is no step."""
    todo = [s for s in statements or () if callable(s) or (s and s.strip())]
    if not todo:
        return None
    start = now_millis()
    results = [_execute(spark, s, ctx) for s in todo]
    return Step(name, start, now_millis(), results)


def append_rows(staging: str, core: str) -> Statement:
    """A statement that appends a staging table to a core table and counts the rows."""
    return lambda spark, ctx: publish_append(spark, ctx.evaluate(staging), ctx.evaluate(core))


def merge_into(
    core: str, staging: str, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> Statement:
    """A statement that merges a staging table into a core table and counts the rows."""
    return lambda spark, ctx: publish_merge(
        spark, ctx.evaluate(core), ctx.evaluate(staging), keys, order_by, ctx=ctx
    )


def purge_load(table: str) -> Statement:
    """A statement that deletes the rows of the current load from a table."""
    return lambda spark, ctx: purge(spark, ctx.evaluate(table), ctx)


def fail_if_used(ledger: str) -> Statement:
    """A statement that stops the run when its table id is already in use."""
    return lambda spark, ctx: assert_unused(spark, ledger, ctx)
