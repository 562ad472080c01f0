from __future__ import annotations

import tempfile

import pytest

from loadkit.context import RunContext
from loadkit.session import build_session, scratch_path


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="loadkit-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    """A database of its own for every test."""
    from loadkit.checks import workspace

    return workspace(spark)


@pytest.fixture
def folder(spark, tmp_path):
    """A fresh local folder for input files."""
    return tmp_path


@pytest.fixture
def path(spark):
    return lambda name: scratch_path(spark, name)


@pytest.fixture
def ctx():
    return RunContext("0123abcdef")
