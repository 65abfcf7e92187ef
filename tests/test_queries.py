"""Every registered query against its SQL on DuckDB, whole tables, value by value."""

import oracle
import pytest

import __spark_entry__ as entry_point

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, data, duck, name):
    frame = QUERIES[name](spark, data)
    names, wanted = oracle.duck_rows(duck, SQL[name])
    assert sorted(frame.columns) == names
    assert oracle.spark_rows(frame) == wanted
    assert wanted


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["segment", "n_orders", "revenue"]
    assert frame.count() == 5
