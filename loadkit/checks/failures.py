"""Failure policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.checks import query, table
from loadkit.operators.binding import ERROR, RAW, bind
from loadkit.operators.routing import ROW_POLICY, UNIT_POLICY, split_bad
from loadkit.session import materialise, scratch_path
from loadkit.sources.delimited import read_delimited
from loadkit.sources.records import MALFORMED

TARGET = T.StructType().add("event_id", T.LongType()).add("value", T.DoubleType())


def _bound_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value arrives as text; large values are not numbers."""
    records = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN value > 330 THEN 'x' ELSE CAST(value AS STRING) END AS value_text",
        "user_id % 50 AS unit",
    )
    bound = bind(records, ["event_id", "value_text"], TARGET, keep=("unit",), errors=True)
    return materialise(bound, "landing")


@query("""
    SELECT event_id, value FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.value > 330 AND b.user_id % 50 = e.user_id % 50)
""")
def failure_unit_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_bad(_bound_events(spark, sf_dir), UNIT_POLICY, unit=["unit"])
    return good.select("event_id", "value")


@query("""
    SELECT event_id, CASE WHEN value > 330 THEN NULL ELSE value END AS value FROM events e
    WHERE EXISTS (SELECT 1 FROM events b WHERE b.value > 330 AND b.user_id % 50 = e.user_id % 50)
""")
def failure_units_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = split_bad(_bound_events(spark, sf_dir), UNIT_POLICY, unit=["unit"])
    return failed.select("event_id", "value")


@query("""
    SELECT event_id, CASE WHEN value > 330 THEN NULL ELSE value END AS value,
           CASE WHEN value > 330 THEN 'failure' ELSE 'success' END AS output,
           CASE WHEN value > 330 THEN 'value_text' END AS error,
           CASE WHEN value > 330 THEN '{"event_id":' || event_id || ',"value_text":"x"}' END AS raw
    FROM events
""")
def failure_row_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = split_bad(_bound_events(spark, sf_dir), ROW_POLICY)
    named = [
        rows.select(
            "event_id",
            "value",
            F.lit(output).alias("output"),
            F.col(ERROR).alias("error"),
            F.col(RAW).alias("raw"),
        )
        for rows, output in ((good, "success"), (bad, "failure"))
    ]
    return named[0].unionByName(named[1])


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id,
           CASE WHEN doc_id % 10 <> 1 THEN CAST(quality AS VARCHAR) END AS quality,
           CASE WHEN doc_id % 10 = 0 THEN doc_id || '|' || quality || '|' || toxic || '|extra'
                WHEN doc_id % 10 = 1 THEN CAST(doc_id AS VARCHAR) END AS malformed
    FROM labels
""")
def malformed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited records with too many and too few fields keep their raw text."""
    line = """
        CASE WHEN doc_id % 10 = 0 THEN concat_ws('|', doc_id, quality, toxic, 'extra')
             WHEN doc_id % 10 = 1 THEN CAST(doc_id AS STRING)
             ELSE concat_ws('|', doc_id, quality, toxic) END AS `doc_id|quality|toxic`
    """
    path = scratch_path(spark, "labels")
    lines = table(spark, sf_dir, "labels").selectExpr(line)
    lines.write.options(header=True, sep="\t", quote="").csv(path)
    read = read_delimited(spark, path, "|")
    return read.select("doc_id", "quality", F.col(MALFORMED).alias("malformed"))
