"""Database targets over JDBC: partitioned reads and writes, and one-transaction scripts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# How often a staging table is filled until it holds the rows sent and no others.
ATTEMPTS = 3
# Options of a load that mean nothing to a read.
WRITE_OPTIONS = ("batchsize", "num_partitions", "isolation")


def read_options(load_options: dict[str, Any]) -> dict[str, Any]:
    """What reads of the same database need of the options of a load, such as user and password."""
    return {name: value for name, value in load_options.items() if name not in WRITE_OPTIONS}


def read_jdbc(spark: SparkSession, url: str, query: str, **properties: str) -> DataFrame:
    """The result set of a query that the database runs."""
    return spark.read.format("jdbc").options(url=url, query=query, **properties).load()


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batchsize: int = 10_000,
    num_partitions: int | None = None,
    isolation: str = "READ_COMMITTED",
    **properties: str,
) -> None:
    """Append rows to a database table with batched inserts from every partition.

    `batchsize=1` sends each row on its own. `num_partitions` bounds the parallel connections.
    Partitions commit on their own, and a retried task sends its rows again, so `table` must be a
    staging table which `jdbc_transaction` publishes once the whole load is known to be right.
    """
    options: dict[str, Any] = {
        "url": url,
        "dbtable": table,
        "batchsize": batchsize,
        "isolationLevel": isolation,
        **properties,
    }
    if num_partitions:
        options["numPartitions"] = num_partitions
    df.write.format("jdbc").mode("append").options(**options).save()


def connector(spark: SparkSession, url: str, user: str = "", password: str = "") -> Callable:
    """A function that opens a connection on the script channel, through the driver's JVM."""
    manager = spark._jvm.java.sql.DriverManager
    if user:
        return lambda: manager.getConnection(url, user, password)
    return lambda: manager.getConnection(url)


def jdbc_transaction(connect: Callable, statements: Sequence[str]) -> list[int]:
    """Run statements in one transaction and return their update counts.

    Any error rolls back all of them. Publishing staged rows is one `INSERT ... SELECT` here: the
    database moves the rows, none pass through Spark.
    """
    connection = connect()
    try:
        connection.setAutoCommit(False)
        counts = []
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
            counts.append(statement.getUpdateCount())
        connection.commit()
        return counts
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def jdbc_statement(connect: Callable, text: str) -> Callable:
    """A script statement for the database, run in a transaction of its own; gives its update count."""
    return lambda spark, ctx: jdbc_transaction(connect, [ctx.evaluate(text)])[0]


def jdbc_query(url: str, text: str, **properties: str) -> Callable:
    """A script statement for the database that returns rows."""
    return lambda spark, ctx: read_jdbc(spark, url, ctx.evaluate(text), **properties)


def load_staged_jdbc(
    df: DataFrame,
    url: str,
    staging: str,
    connect: Callable,
    publish: Sequence[str],
    before_publish: Callable[[DataFrame], None] = lambda rows: None,
    **load_options: Any,
) -> int:
    """Fill a staging table in parallel, then publish it in one transaction; return the rows sent.

    The final table changes only in the last step, so a failed partition leaves it as it was. A
    retried task can leave extra rows in the staging table, which is why its row count must equal
    the rows sent before anything is published; if it does not, the table is emptied and filled again.
    """
    spark, reading = df.sparkSession, read_options(load_options)
    for attempt in range(ATTEMPTS):
        if attempt:
            jdbc_transaction(connect, [f"DELETE FROM {staging}"])
        sent = Observation(f"rows_sent_{attempt}")
        load_jdbc(df.observe(sent, F.count(F.lit(1)).alias("rows")), url, staging, **load_options)
        rows = sent.get["rows"]
        count = f"SELECT COUNT(*) AS N FROM {staging}"
        found = read_jdbc(spark, url, count, **reading).first()[0]
        if found == rows:
            break
    else:
        raise RuntimeError(f"{staging} holds {found} rows, {rows} were sent")
    before_publish(read_jdbc(spark, url, f"SELECT * FROM {staging}", **reading))
    jdbc_transaction(connect, publish)
    return rows
