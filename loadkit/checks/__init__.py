"""Registered queries over the test tables, with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadkit.context import new_context
from loadkit.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under the name of its function."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> str:
    """A fresh database whose tables live in the shared scratch folder."""
    name = f"loadkit_{new_context().table_id}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def load_all() -> None:
    """Import every module that registers queries."""
    from loadkit.checks import (  # noqa: F401
        binding,
        careful,
        elt,
        failures,
        files,
        loads,
        records,
        reports,
        streams,
    )
