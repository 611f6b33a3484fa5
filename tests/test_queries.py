"""Every registered query with SQL against DuckDB, row by row."""

import oracle_check
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return oracle_check.duck(sf)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, duck, sf, name):
    message, _ = oracle_check.compare(spark, duck, QUERIES[name], SQL[name], sf)
    assert message is None
