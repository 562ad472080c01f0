"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from loadkit.checks import ORACLES, QUERIES
from tests.oracle import TABLES, compare, connect

SF_DIR = f"{TABLES}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) == []


def test_entry(spark):
    assert entry(spark).count() > 0
