import pytest

import __spark_entry__ as contract
import oracle
from conftest import SMALL

from tickloom.plans.tables import build_queries
from tickloom.plans.tables_sql import build_sql

QUERIES, SQL = build_queries(), build_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert oracle.difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("name", ["daily", "intraday_5min", "daily_adj", "compact_daily", "slices_all"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["symbol", "timestamp", "open", "high", "low", "close", "volume"]
    assert result.count() > 0
