"""What became of every file: pending while its load is under way, then loaded or failed.

A load writes its files before it is published and one end after it: published or refused. Neither says
anything alone, so a file counts as loaded only behind the publish of the attempt that wrote it. Of a
load that died between the two, the partition of its core table tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.context import COMMIT_EPOCH, TABLE_ID, RunContext, with_context
from loadkit.operators.binding import ERROR
from loadkit.operators.loading import published_loads
from loadkit.operators.routing import UNIT_POLICY
from loadkit.session import exists
from loadkit.sources.records import UNIT

LOADED, FAILED, PENDING = "loaded", "failed", "pending"
PUBLISHED, REFUSED = "published", "refused"
_FILES, _ENDS = "files", "ends"
_CONTEXT = f"{TABLE_ID} string, {COMMIT_EPOCH} int, attempt string"
FILE = f"{UNIT} string, kept boolean, rows bigint, bad bigint, {_CONTEXT}"
END = f"{UNIT} string, ended string, {_CONTEXT}"
_LOAD = [TABLE_ID, COMMIT_EPOCH, "attempt"]


def _append(rows: DataFrame, ctx: RunContext, path: str, folder: str) -> None:
    stamped = with_context(rows, ctx).withColumn("attempt", F.lit(ctx.attempt))
    stamped.write.mode("append").parquet(f"{ctx.evaluate(path)}/{folder}")


def note_files(landed: DataFrame, policy: str, ctx: RunContext, path: str) -> None:
    """Write the files of a landing with their records: pending until the load ends."""
    counted = landed.groupBy(UNIT).agg(F.count("*").alias("rows"), F.count(ERROR).alias("bad"))
    kept = (F.col("bad") == 0) | F.lit(policy != UNIT_POLICY)
    _append(counted.select(UNIT, kept.alias("kept"), "rows", "bad"), ctx, path, _FILES)


def note_end(spark: SparkSession, unit: str, ended: str, ctx: RunContext, path: str) -> None:
    """Write how the load of a unit ended; later ends of one attempt do not count."""
    row = spark.createDataFrame([(unit, ended)], f"{UNIT} string, ended string")
    _append(row, ctx, path, _ENDS)


def _read(spark: SparkSession, path: str, folder: str, schema: str) -> DataFrame:
    if not exists(spark, f"{path}/{folder}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{folder}")


def read_outcomes(spark: SparkSession, path: str, core: str | None = None) -> DataFrame:
    """Per file and load: _unit, status, rows, bad, TABLE_ID, COMMIT_EPOCH.

    Files of a published load are loaded, or failed if bad records kept them out; those of a refused
    load failed, and so did a unit that raised before its files were known (rows and bad are null
    there). Without an end a file is pending; given the core table, the partition of the load says
    whether it is loaded or failed. A file that was loaded in the end is not failed as well.
    """
    files = _read(spark, path, _FILES, FILE)
    ends = _read(spark, path, _ENDS, END).withColumn("published", F.col("ended") == PUBLISHED)
    by_load = ends.groupBy(*_LOAD).agg(F.max("published").alias("published"))
    known = files.join(by_load, _LOAD, "left")
    if core:
        open_loads = known.filter("published IS NULL").select(TABLE_ID).distinct()
        # Only loads that died have no end.
        ids = [row[TABLE_ID] for row in open_loads.collect()]
        found = published_loads(spark, core, ids).withColumn("there", F.lit(True))
        known = known.join(found, [TABLE_ID, COMMIT_EPOCH], "left")
        there = F.coalesce("there", F.lit(False))
        known = known.withColumn("published", F.coalesce("published", there)).drop("there")
    status = (
        F.when(F.col("published").isNull(), PENDING)
        .when(F.col("published") & F.col("kept"), LOADED)
        .otherwise(FAILED)
    )
    known = known.select(UNIT, status.alias("status"), "rows", "bad", TABLE_ID, COMMIT_EPOCH)
    nothing = F.lit(None).cast("bigint")
    raised = ends.filter(~F.col("published")).join(files, _LOAD, "left_anti").select(
        UNIT, F.lit(FAILED).alias("status"), nothing.alias("rows"), nothing.alias("bad"), TABLE_ID, COMMIT_EPOCH
    )
    every = known.unionByName(raised.distinct())
    loaded = every.filter(F.col("status") == LOADED).select(F.col(UNIT).alias("_later")).distinct()
    failed = every.filter(F.col("status") != LOADED)
    open_still = failed.join(loaded, F.col(UNIT).eqNullSafe(F.col("_later")), "left_anti")
    return every.filter(F.col("status") == LOADED).unionByName(open_still)
