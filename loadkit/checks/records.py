"""Record formats and delimited bulk data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.checks import query, table, workspace
from loadkit.operators.binding import bind_by_name
from loadkit.operators.loading import load_delimited
from loadkit.session import scratch_path
from loadkit.sources.delimited import read_delimited, write_delimited
from loadkit.sources.records import read_records

EVENTS_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"


def _through(spark: SparkSession, sf_dir: str, fmt: str, **options) -> DataFrame:
    """Events written in a record format and scanned back with a declared schema."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props"
    )
    path = scratch_path(spark, fmt)
    events.write.format(fmt).options(**options).save(path)
    records = read_records(spark, path, fmt, events.schema, **options)
    return bind_by_name(records, events.schema)


@query(EVENTS_SQL)
def records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "json")


@query(EVENTS_SQL)
def records_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "orc")


@query(EVENTS_SQL)
def records_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "parquet")


@query(EVENTS_SQL)
def records_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "xml", rowTag="event", rootTag="events")


@query(EVENTS_SQL)
def records_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "csv", header=True, escape='"')


@query("SELECT doc_id, translate(text, '|' || chr(10) || chr(13), '   ') AS text, source FROM documents")
def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as delimited text with a header, bulk loaded into a table."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "documents")
    write_delimited(documents, path, "|")
    target = f"{workspace(spark)}.documents_core"
    spark.sql(f"CREATE TABLE {target} (doc_id BIGINT, text STRING, source STRING) USING parquet")
    load_delimited(spark, path, target, "|")
    return spark.table(target)


@query("""
    SELECT c_name, c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal,
           c_mktsegment || chr(233) AS segment
    FROM customer
""")
def delimited_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another delimiter, another charset, and large units merged from small packages."""
    customers = table(spark, sf_dir, "customer").select(
        "c_name", "c_custkey", "c_acctbal", F.concat("c_mktsegment", F.lit("é")).alias("segment")
    )
    path = scratch_path(spark, "customers")
    write_delimited(customers, path, ";", charset="ISO-8859-1", target_bytes=100_000)
    text = read_delimited(spark, path, ";", "ISO-8859-1")
    target = T.StructType.fromDDL(
        "c_name STRING, c_custkey BIGINT, c_acctbal DECIMAL(12,2), segment STRING"
    )
    return bind_by_name(text, target)


@query("SELECT page_id, url, translate(html, ';' || chr(10) || chr(13), '   ') AS html FROM pages")
def delimited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "pages")
    write_delimited(pages, path, ";")
    target = T.StructType.fromDDL("page_id BIGINT, url STRING, html STRING")
    return bind_by_name(read_delimited(spark, path, ";"), target)
