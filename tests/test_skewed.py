"""Queries against their SQL where a third of the rows share a key and keys are missing or NULL."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences
from skewed_data import write_skewed

import __spark_entry__ as contract
from salesloom.plans import catalog

NAMES = sorted(name for name, entry in catalog.ENTRIES.items() if entry.sql is not None)


@pytest.fixture(scope="module")
def folder(sf_dir, tmp_path_factory):
    return write_skewed(sf_dir, tmp_path_factory.mktemp("skewed"))


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_keys(spark, folder, duck, name):
    df = contract.queries()[name](spark, folder)
    assert differences(df, duck, contract.oracle_sql()[name]) == []


def test_skewed_keys_without_broadcasts(spark, folder, duck):
    from salesloom.plans.session import session_conf

    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for name in ("star_join", "daily_sales", "customer_activity", "fk_orphans"):
            df = contract.queries()[name](spark, folder)
            assert differences(df, duck, contract.oracle_sql()[name]) == []


def test_a_hot_order_is_split_in_the_join(spark, folder):
    """The one row-level join of large tables: adaptive execution cuts the hot key's rows."""
    from salesloom.plans.session import session_conf
    from salesloom.sources.star_views import StarViews

    with session_conf(
        spark,
        spark__sql__files__maxPartitionBytes="32k",
        spark__sql__files__openCostInBytes="1k",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="24k",
    ):
        sales = StarViews(spark, folder).sales()
        found = sales.collect()
        plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(found) == StarViews(spark, folder).lines().count()
