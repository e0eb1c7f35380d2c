"""Every registered query against its SQL on the smallest test tables."""

import __spark_entry__ as driver
import pytest
from compare import connect, differences
from conftest import plan_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = driver.QUERIES, driver.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert differences(df, con, ORACLE[name]) == []


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert sum(r.n_orders for r in rows) > 0
