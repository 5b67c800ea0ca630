"""Every registered query with an oracle agrees with DuckDB on the driver's tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.oracle import compare, duck

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    assert compare(df, con, ORACLE[name]) is None


def test_nothing_stays_cached(spark):
    """After all entries the stored tables are read again, not an earlier query's cache."""
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0
    df = E.queries()["kpi"](spark, SF_ORACLE)
    assert "InMemoryTableScan" not in df._jdf.queryExecution().executedPlan().toString()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_ORACLE)
    assert df.count() >= 0
    assert df.columns
