"""Every registered query against its SQL, and the driver's contract."""

from __future__ import annotations

import re

import pytest
from oracle_check import SAME_TYPE, connect, differences

import __spark_entry__ as contract
from salesloom.plans import catalog

# The queries of other folders have tests beside them.
QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)
    assert len(QUERIES) > 55


def test_entry_is_the_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["product_id", "revenue", "product_name", "category"]
    assert df.count() == 10


def test_types_are_comparable(spark, sf_dir):
    df = QUERIES["star_join"](spark, sf_dir)
    assert {f.dataType.simpleString() for f in df.schema.fields} <= set(SAME_TYPE)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["star_join", "revenue_by_location", "customer_activity", "fk_orphans", "top_products_named"],
)
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["top_products", "sales_by_store", "revenue_by_category"])
def test_metrics_without_dates_do_not_read_orders(spark, sf_dir, name):
    assert "orders.parquet" not in plan_of(QUERIES[name](spark, sf_dir))


def test_only_needed_columns_are_scanned(spark, sf_dir):
    plan = plan_of(QUERIES["top_products"](spark, sf_dir))
    assert re.findall(r"ReadSchema: (\S+)", plan) == [
        "struct<l_partkey:bigint,l_extendedprice:double>"
    ]


def test_periods_are_pushed_to_the_scan_of_orders(spark, sf_dir):
    from salesloom.plans.session import session_conf
    from salesloom.sources.star_views import StarViews

    with session_conf(spark, spark__sql__maxMetadataStringLength="1000"):
        plan = plan_of(StarViews(spark, sf_dir).orders(("2001-07-01", "2001-08-01")))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan)[1]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_joins_are_merged_above_the_broadcast_limit(spark, sf_dir):
    from salesloom.plans.session import session_conf

    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = QUERIES["star_join"](spark, sf_dir)
        assert "BroadcastHashJoin" not in plan_of(df)
        merged = df.count()
    assert merged == QUERIES["star_join"](spark, sf_dir).count()
