"""Every registered query against its DuckDB statement (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tidemark import catalog, oracle
from oracle_compare import compare, duck
from conftest import SF_SMALL

QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL, QUERIES[name], SQL[name])
    assert ok, msg


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["repo_name", "momentum_score"]
