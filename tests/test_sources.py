from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.operators.binding import ERROR, bind, bind_by_name
from loadkit.operators.loading import load_delimited
from loadkit.sources.delimited import read_delimited, read_header, write_delimited
from loadkit.sources.records import (
    MALFORMED,
    UNIT,
    UNIT_SIZE,
    SchemaMissing,
    list_units,
    read_records,
    require_schema,
)

DDL = T.StructType.fromDDL
LINES = 'id|v|n\n1|2.5|"a\n2|x|b\n3|3.5|c|extra\n4|1.5\n5||e\n'


def bound(df, ddl="id int, v double, n string"):
    return bind_by_name(df, DDL(ddl), errors=True)


def test_delimited_records(spark, folder):
    (folder / "a.csv").write_text(LINES)
    df = bound(read_delimited(spark, str(folder)))
    rows = {r[ERROR] or r["id"]: r for r in df.filter("_error IS NULL OR _error <> 'malformed'").collect()}
    assert rows[1]["n"] == '"a'
    assert rows[5]["v"] is None
    assert rows["v"]["_raw"] == '{"id":"2","v":"x","n":"b"}'
    malformed = df.filter("_error = 'malformed'").collect()
    assert sorted(r["_raw"] for r in malformed) == ["3|3.5|c|extra", "4|1.5"]


def test_malformed_records_show_in_every_projection(spark, folder):
    (folder / "a.csv").write_text(LINES)
    df = read_delimited(spark, str(folder))
    assert len(df.filter(F.col(MALFORMED).isNotNull()).select("id", MALFORMED).collect()) == 2


def test_charset_and_other_delimiter(spark, folder):
    (folder / "a.csv").write_bytes("id;n\n1;é|x\n".encode("latin-1"))
    df = read_delimited(spark, str(folder), ";", "ISO-8859-1")
    assert [tuple(r)[:2] for r in df.collect()] == [("1", "é|x")]


def test_header_gives_the_order(spark, folder, db):
    (folder / "a.csv").write_text("n|id\nx|1\n")
    spark.sql(f"CREATE TABLE {db}.t (id INT, v DOUBLE DEFAULT 0.5, n STRING) USING parquet")
    assert read_header(spark, str(folder), "|") == ["n", "id"]
    assert load_delimited(spark, str(folder), f"{db}.t").rows == 1
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [(1, 0.5, "x")]


def test_files_with_different_headers_are_refused(spark, folder):
    (folder / "a.csv").write_text("id|n\n1|x\n")
    (folder / "b.csv").write_text("n|id\ny|2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(folder)).collect()


def test_units_without_records(spark, folder, db):
    (folder / "a.csv").write_text("id|n\n")
    spark.sql(f"CREATE TABLE {db}.t (id INT, n STRING) USING parquet")
    assert load_delimited(spark, str(folder), f"{db}.t").rows == 0
    (folder / "empty").mkdir()
    (folder / "empty" / "a.csv").write_text("")
    with pytest.raises(SchemaMissing, match="no header"):
        read_delimited(spark, str(folder / "empty"))


def test_unknown_columns_are_refused(spark, folder, db):
    (folder / "a.csv").write_text("id|other\n1|x\n")
    spark.sql(f"CREATE TABLE {db}.t (id INT) USING parquet")
    with pytest.raises(SchemaMissing, match="other"):
        load_delimited(spark, str(folder), f"{db}.t")


def test_bad_records_leave_the_table_alone(spark, folder, db):
    (folder / "a.csv").write_text(LINES)
    spark.sql(f"CREATE TABLE {db}.t (id INT, v DOUBLE, n STRING) USING parquet")
    with pytest.raises(Exception, match="cannot load record"):
        load_delimited(spark, str(folder), f"{db}.t")
    assert spark.table(f"{db}.t").isEmpty()


def test_written_text_comes_back(spark, path):
    texts = ["", " lead", "trail ", '"quoted"', "a|b", "l1\nl2\r", "back\\slash\\", "#c", "tab\t", "\0nul", "é漢"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    where = path("delimited")
    write_delimited(df, where)
    got = bind(read_delimited(spark, where), ["id", "t"], df.schema, errors=True)
    assert got.filter("_error IS NOT NULL").isEmpty()
    clean = str.maketrans("|\n\r\0", "    ")
    want = {i: t.translate(clean) or None for i, t in enumerate(texts)}
    assert {r["id"]: r["t"] for r in got.collect()} == want


def test_small_packages_are_merged(spark, path):
    small, large = path("small"), path("large")
    df = spark.range(1000).repartition(16)
    write_delimited(df, small)
    write_delimited(df, large, target_bytes=1_000_000)
    assert list_units(spark, small, "*.csv").count() == 16
    assert list_units(spark, large, "*.csv").count() == 1
    assert read_delimited(spark, large).count() == 1000


def test_json_records(spark, folder):
    (folder / "a.json").write_text('{"id":1,"d":"2024-01-02","x":1.5}\n{bad\n{"id":2,"d":"nope"}\n')
    schema = DDL("id int, d date, x double")
    df = read_records(spark, str(folder), "json", schema)
    whole = bind_by_name(df, schema, errors=True).filter("_error IS NOT NULL").collect()
    assert sorted(r["_raw"] for r in whole) == ['{"id":2,"d":"nope"}', "{bad"]


def test_a_malformed_field_counts_even_if_it_is_not_bound(spark, folder):
    (folder / "a.json").write_text('{"id":1,"d":"2024-01-02"}\n{"id":2,"d":"nope"}\n')
    df = read_records(spark, str(folder), "json", DDL("id int, d date"))
    rows = bind(df, ["id"], DDL("id int"), errors=True).collect()
    assert [(r["id"], r["_error"]) for r in rows] == [(1, None), (2, "malformed")]


def test_unit_metadata(spark, folder):
    (folder / "a.json").write_text('{"id":1}\n')
    (folder / "b.json").write_text('{"id":2}\n{"id":3}\n')
    df = read_records(spark, str(folder), "json", DDL("id int"))
    rows = {r["id"]: (r[UNIT].rsplit("/")[-1], r[UNIT_SIZE]) for r in df.collect()}
    assert rows == {1: ("a.json", 9), 2: ("b.json", 18), 3: ("b.json", 18)}
    listed = list_units(spark, str(folder), "*.json").collect()
    assert sorted(r[UNIT_SIZE] for r in listed) == [9, 18]


def test_a_schema_is_required(spark, folder):
    with pytest.raises(SchemaMissing):
        read_records(spark, str(folder), "json", None)
    df = spark.range(1)
    assert require_schema(df, ["id"]) is df
    with pytest.raises(SchemaMissing, match="'x'"):
        require_schema(df, ["id", "x"])
