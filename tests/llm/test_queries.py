"""Registered queries against their SQL, and the names the driver expects."""

import re

import pytest

import __spark_entry__ as driver
from brookmart.llm.queries import QUERIES, SQL
from tests.check import compare, connect

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    con = connect(SF)
    assert compare(spark, con, SF, QUERIES[name], SQL[name]) == ""
    con.close()
