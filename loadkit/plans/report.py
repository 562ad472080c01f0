"""The load report: one typed row per load, and what can be read from many of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.context import RunContext
from loadkit.operators.loading import LoadResult
from loadkit.plans.scripts import Step

RESULT_SET = "struct<updateCount:bigint,location:string>"
STEP = (
    "struct<name:string,meantime:bigint,start:bigint,stop:bigint,elapsed:bigint,"
    f"resultSets:array<{RESULT_SET}>>"
)
REPORT_SCHEMA = (
    "start bigint, stop bigint, elapsed bigint, size bigint, "
    "attributes struct<TABLE_ID:string,COMMIT_EPOCH:int>, "
    f"steps array<{STEP}>, "
    "load struct<start:bigint,stop:bigint,elapsed:bigint,updateCount:bigint>"
)


def meantimes(start: int, steps: Sequence[Step]) -> list[int]:
    """The time between each step and the one before it; the first counts from the report's start."""
    stops = [start, *(s.stop for s in steps)]
    return [step.start - stop for step, stop in zip(steps, stops, strict=False)]


def report_row(
    ctx: RunContext,
    size: int,
    steps: Sequence[Step | None],
    load: LoadResult | None,
    start: int,
    stop: int,
) -> tuple:
    """A report as a tuple that fits `REPORT_SCHEMA`; skipped scripts are left out."""
    ran = [s for s in steps if s]
    step_rows = [
        (s.name, gap, s.start, s.stop, s.stop - s.start, [r.as_row() for r in s.result_sets])
        for s, gap in zip(ran, meantimes(start, ran), strict=True)
    ]
    load_row = load and (load.start, load.stop, load.stop - load.start, load.rows)
    return (
        start,
        stop,
        stop - start,
        size,
        (ctx.table_id, ctx.commit_epoch),
        step_rows,
        load_row,
    )


def build_reports(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), REPORT_SCHEMA)


def write_reports(reports: DataFrame, path: str, as_json: bool = False) -> None:
    """Append reports to a folder, typed or as JSON documents."""
    writer = reports.write.mode("append")
    writer.json(path) if as_json else writer.parquet(path)


def read_reports(spark: SparkSession, path: str, ctx: RunContext) -> DataFrame:
    """The reports of one run in a folder of typed reports."""
    reports = spark.read.schema(REPORT_SCHEMA).parquet(path)
    return reports.filter(F.col("attributes.TABLE_ID") == ctx.table_id)


def report_json(reports: DataFrame, pretty: bool = False) -> DataFrame:
    """Each report as one JSON text; absent values are left out."""
    document = F.to_json(F.struct("*"), {"pretty": str(pretty).lower()})
    return reports.select(document.alias("report"))


def with_meantime(steps: Column, report_start: Column) -> Column:
    """Set the meantime of every step in a column of step arrays, which are in order.

    Works inside the row: steps of a report need neither a shuffle nor a window.
    """

    def step_with_gap(step: Column, i: Column) -> Column:
        before = F.when(i == 0, report_start).otherwise(F.get(steps, i - 1)["stop"])
        return step.withField("meantime", step["start"] - before)

    return F.transform(steps, step_with_gap)


def explode_steps(reports: DataFrame, *keep: str) -> DataFrame:
    """One row per step with its position in the report."""
    exploded = reports.select(
        F.col("attributes.TABLE_ID").alias("TABLE_ID"),
        F.col("attributes.COMMIT_EPOCH").alias("COMMIT_EPOCH"),
        *keep,
        F.posexplode("steps").alias("step_no", "step"),
    )
    parts = ("name", "meantime", "start", "stop", "elapsed")
    return exploded.select(
        "TABLE_ID", "COMMIT_EPOCH", *keep, "step_no", *[f"step.{p}" for p in parts]
    )


def step_summary(reports: DataFrame) -> DataFrame:
    """Per step name: how often it ran and how much time it and the wait before it took."""
    return explode_steps(reports).groupBy("name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("elapsed").alias("elapsed"),
        F.max("elapsed").alias("max_elapsed"),
        F.sum("meantime").alias("meantime"),
    )


def load_summary(reports: DataFrame) -> DataFrame:
    """Rows, bytes and throughput of all loads of a run."""
    loads = reports.filter(F.col("load").isNotNull())
    rows, elapsed = F.sum("load.updateCount"), F.sum("load.elapsed")
    return loads.groupBy(F.col("attributes.TABLE_ID").alias("TABLE_ID")).agg(
        F.count(F.lit(1)).alias("loads"),
        rows.alias("rows"),
        F.sum("size").alias("bytes"),
        elapsed.alias("elapsed"),
        F.try_divide(rows * 1000, elapsed).alias("rows_per_second"),
    )
