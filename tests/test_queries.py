"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from farelake.plans import registry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
# The log of the smallest tables has no row for these.
EMPTY = {"active_blacklist", "uncovered_failures"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    problem = compare(df, con, entry.oracle_sql()[name])
    assert problem is None or (name in EMPTY and problem == "no rows at all")


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "route", "dep_date", "return_date", "flight_type", "currency", "snapshot_date", "price", "airline", "n_offers"
    ]


def test_no_query_without_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
