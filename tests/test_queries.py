"""Every registered query that has SQL gives the rows of that SQL on the smallest driver tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_queries  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402


@pytest.fixture(scope="module")
def connection(sf):
    return check_queries.connect(sf)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, sf, name):
    line = check_queries.compare(spark, connection, sf, name)
    assert not line.startswith("FAIL"), line


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
