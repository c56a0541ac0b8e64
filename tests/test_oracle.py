"""Every registered query with an oracle: Spark result equals the DuckDB
result (rounded, order-free) on the smallest driver tables."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

import __spark_entry__ as E

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    info = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert info["ok"], info


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["stock_code", "mean_purchases", "max_purchases"]
    assert df.count() > 0
