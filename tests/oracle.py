"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import decimal
import glob
import os
from collections import Counter

import duckdb

TABLES = os.environ.get("LOADKIT_TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """The same Python value for equal results of both engines."""
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs, as text; empty when the results agree."""
    df = query(spark, sf_dir)
    got = df.collect()
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    rows = want.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    left, right = bag(df.columns, got), bag(names, rows)
    found = []
    if len(got) != len(rows):
        found.append(f"{len(got)} rows != {len(rows)}")
    found += [f"only Spark: {r}" for r in list((left - right))[:3]]
    found += [f"only SQL: {r}" for r in list((right - left))[:3]]
    return found
