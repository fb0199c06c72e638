"""Every query that has reference SQL against DuckDB on the same tables; the corpus queries without one have tests of their own."""

import pytest

import __spark_entry__ as entry
from checks.queries import registry
from tests.compare import connect, duckdb_rows, spark_rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_own_query_has_reference_sql():
    assert set(registry()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_duckdb(spark, duck, sf_dir, name):
    result = entry.queries()[name](spark, sf_dir)
    assert not any(kind.startswith("decimal") for _, kind in result.dtypes)
    found = spark_rows(result)
    assert found == duckdb_rows(duck, entry.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() == 20
