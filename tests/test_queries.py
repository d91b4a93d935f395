"""Every registered query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SMALL, QUERIES[name], ORACLE.get(name)) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
