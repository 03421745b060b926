"""Every registered query against its SQL."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as registered
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("DAYMARK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Operators that leave the JVM, or that meet every row with every other.
UNWANTED = ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoopJoin")


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    assert difference(df, con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert ORACLES.keys() == QUERIES.keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
