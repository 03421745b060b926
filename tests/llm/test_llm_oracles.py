"""Queries that SQL can express, against it."""

import os

import pytest
from oracle import connect, difference

from daymark.llm.oracles import ORACLES
from daymark.llm.queries import QUERIES

SF_DIR = os.environ.get("DAYMARK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None
