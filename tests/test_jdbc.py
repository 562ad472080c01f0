"""Database targets without a database: what is sent, in which order, and what is rolled back."""

from __future__ import annotations

import pytest

from loadkit.context import RunContext
from loadkit.operators import database
from loadkit.operators.database import jdbc_loader
from loadkit.plans.run import LoadSpec
from loadkit.sources import jdbc
from loadkit.sources.jdbc import jdbc_statement, jdbc_transaction, load_jdbc, load_staged_jdbc


class Connection:
    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def setAutoCommit(self, on):  # noqa: N802
        self.log.append(("autocommit", on))

    def createStatement(self):  # noqa: N802
        return self

    def execute(self, text):
        if text == self.fail_on:
            raise RuntimeError(text)
        self.log.append(text)

    def getUpdateCount(self):  # noqa: N802
        return len(self.log)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


class Writer:
    """Stands in for a frame: records how it would be written."""

    def __init__(self):
        self.said = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.said["format"] = name
        return self

    def mode(self, name):
        self.said["mode"] = name
        return self

    def options(self, **options):
        self.said.update(options)
        return self

    def save(self):
        self.said["saved"] = True


def test_transaction():
    connection = Connection()
    assert jdbc_transaction(lambda: connection, ["a", "b"]) == [2, 3]
    assert connection.log == [("autocommit", False), "a", "b", "commit", "close"]


def test_an_error_rolls_all_back():
    connection = Connection(fail_on="b")
    with pytest.raises(RuntimeError, match="b"):
        jdbc_transaction(lambda: connection, ["a", "b", "c"])
    assert connection.log == [("autocommit", False), "a", "rollback", "close"]


@pytest.mark.parametrize(("size", "parallel"), [(1, None), (5000, 4)])
def test_load_options(size, parallel):
    frame = Writer()
    load_jdbc(frame, "jdbc:x", "STG", size, parallel, user="u")
    want = {
        "format": "jdbc",
        "mode": "append",
        "url": "jdbc:x",
        "dbtable": "STG",
        "batchsize": size,
        "isolationLevel": "READ_COMMITTED",
        "user": "u",
        "saved": True,
    }
    assert frame.said == (want | {"numPartitions": parallel} if parallel else want)


@pytest.fixture
def table(spark, monkeypatch):
    """A staging table in memory instead of in a database."""
    stored = []

    def send(df, url, name, **options):
        stored.extend(tuple(r) for r in df.collect())

    def read(session, url, query, **options):
        if "COUNT" in query:
            return session.createDataFrame([(len(stored),)], "n long")
        rows = [] if "1 = 0" in query else stored
        return session.createDataFrame(rows, "ID int, V double")

    monkeypatch.setattr(jdbc, "load_jdbc", send)
    monkeypatch.setattr(jdbc, "read_jdbc", read)
    monkeypatch.setattr(database, "read_jdbc", read)
    return stored


def five(spark):
    return spark.range(5).selectExpr("CAST(id AS INT) AS ID", "1D AS V")


def test_staged_load(spark, table):
    connection = Connection()
    sent = load_staged_jdbc(five(spark), "u", "STG", lambda: connection, ["publish"])
    assert sent == 5
    assert connection.log[1:] == ["publish", "commit", "close"]


def test_extra_rows_in_staging_stop_the_publish(spark, table):
    table.append((0, 0))
    connection = Connection()
    with pytest.raises(RuntimeError, match="rows, 5 were sent"):
        load_staged_jdbc(five(spark), "u", "STG", lambda: connection, ["publish"])
    assert "DELETE FROM STG" in connection.log and "publish" not in connection.log


def test_a_staging_table_with_extra_rows_is_filled_again(spark, table, monkeypatch):
    def transaction(connect, statements):
        done.extend(statements)
        if statements == ["DELETE FROM STG"]:
            table.clear()

    done = []
    monkeypatch.setattr(jdbc, "jdbc_transaction", transaction)
    table.append((0, 0))
    assert load_staged_jdbc(five(spark), "u", "STG", None, ["publish"]) == 5
    assert done == ["DELETE FROM STG", "publish"] and len(table) == 5


def test_reads_have_the_credentials_of_the_load():
    options = {"user": "u", "password": "p", "batchsize": 7, "num_partitions": 2}
    assert jdbc.read_options(options) == {"user": "u", "password": "p"}


def test_loader(spark, table):
    connection, seen = Connection(), []
    load = jdbc_loader("u", "STG_%TABLE_ID%", ["INSERT %COMMIT_EPOCH%"], lambda: connection)
    frame = spark.createDataFrame([("1", "2.5")], "b string, a string")
    spec = LoadSpec("T", fields=["b", "a"])
    result = load(frame, spec, RunContext("0123abcdef"), lambda rows: seen.append(rows.count()))
    assert (result.rows, table, seen) == (1, [(1, 2.5)], [1])
    assert connection.log[1] == "INSERT 0"
    bad = spark.createDataFrame([("x", "2.5")], "b string, a string")
    with pytest.raises(Exception, match="cannot load record"):
        load(bad, spec, RunContext("0123abcdef"), lambda rows: None)


def test_statement_on_the_script_channel():
    connection = Connection()
    statement = jdbc_statement(lambda: connection, "DROP STG_%TABLE_ID%")
    assert statement(None, RunContext("0123abcdef")) == 2
    assert connection.log[1] == "DROP STG_0123abcdef"
