"""Registered queries against their SQL, and the driver's contract for this folder."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

from salesloom.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_the_native_operator_runs_no_python(spark, sf_dir):
    plan = QUERIES["op4_license"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
