"""Every query with a DuckDB text must give the same rows on the smallest data."""

import pytest
from tests.conftest import SMALL

import __spark_entry__ as entry
from tools.check import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_text_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 50


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert compare(name, spark, con, SMALL, SQL).startswith("ok")
