"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    assert difference(queries()[name](spark, SMALL), duck, oracle_sql()[name]) is None
