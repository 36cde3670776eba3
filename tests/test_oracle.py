"""Every query with a SQL twin gives the same rows as DuckDB on the same tables."""

import pytest
from compare import connect, mismatch

from wagelens.checks import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    assert mismatch(df, duck, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
