"""Every query against its SQL on the smallest tables; the rest must give rows."""

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, data, name):
    assert compare(spark, con, data, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["category", "orders", "revenue", "profit", "customers", "avg_price"]
    assert result.count() == 6
