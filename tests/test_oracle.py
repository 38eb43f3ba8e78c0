"""Every registered query against its DuckDB oracle (strict where an oracle exists)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from oracle_harness import compare, duck

QUERIES = entry_mod.queries()
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "weighted_rate" in df.columns


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
