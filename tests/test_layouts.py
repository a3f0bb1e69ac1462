"""Stored layouts: lines and orders by key, pruning at run time, fingerprints, footers."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from oracle_check import connect, differences
from plans import files_read, nodes, rows_shuffled
from pyspark.sql import functions as F

from salesloom.operators import compare, metrics, star
from salesloom.plans import catalog, loading
from salesloom.plans.session import work_dir
from salesloom.sources.colocated import CoLocatedViews
from salesloom.sources.star_views import StarViews

SALES = "sales"


def names(df) -> list[str]:
    return [n.nodeName() for n in nodes(df)]


def test_lines_and_orders_are_joined_without_an_exchange(spark, sf_dir):
    views = loading.colocated(spark, sf_dir)
    for rows in (views.sales(), views.sales(("2000-01-01", "2001-01-01"))):
        found = names(rows)
        assert "SortMergeJoin" in found
        assert not [n for n in found if "Exchange" in n]
    plan = metrics.daily_sales(views.sales())._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(order_id" not in plan and "Broadcast" not in plan


def hot_tables(spark, folder: str) -> StarViews:
    """Lines of which a third belong to one order, some to none, and some to an unknown one."""
    chance = random.Random(1)
    lines = [(7 if k % 3 == 0 else None if k % 50 == 1 else chance.randrange(60), k, 1, 2.0, float(k), 0.1) for k in range(900)]
    lines += lines[:5]
    orders = [(k, dt.datetime(2026, 1, 1 + k % 28), k) for k in range(50)]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double"
    spark.createDataFrame(lines, kinds).write.parquet(f"{folder}/lineitem.parquet")
    kinds = "o_orderkey long, o_orderdate timestamp_ntz, o_custkey long"
    spark.createDataFrame(orders, kinds).write.parquet(f"{folder}/orders.parquet")
    return StarViews(spark, folder)


def test_hot_orders_and_lines_without_order_stay_out_of_the_buckets(spark):
    path = work_dir(spark, "hot")
    views = hot_tables(spark, path)
    stored = CoLocatedViews.write(views, path.rsplit("/", 1)[1].replace("-", "_"), f"{path}/layout", 4, always=100)
    inside = spark.read.parquet(f"{path}/layout/lines")
    assert inside.where("order_id = 7 OR order_id IS NULL").count() == 0
    assert spark.read.parquet(f"{path}/layout/apart").where("order_id = 7").count() > 300
    assert len(spark.read.parquet(f"{path}/layout/lines").inputFiles()) <= 4
    key = lambda r: [(v is not None, v) for v in r]
    for between in (None, ("2026-01-03", "2026-01-09"), ("2026-01-03", None)):
        mine, its = stored.sales(between), views.sales(between)
        assert mine.columns == its.columns
        assert sorted(mine.collect(), key=key) == sorted(its.collect(), key=key)
    assert sorted(stored.lines().collect(), key=key) == sorted(views.lines().collect(), key=key)


@pytest.mark.parametrize("name", ["daily_sales", "sales_by_month", "customer_activity"])
def test_reports_over_the_layout_equal_sql(spark, sf_dir, name, monkeypatch):
    views = loading.colocated(spark, sf_dir)
    monkeypatch.setattr(catalog, "StarViews", lambda *_: views)
    assert differences(catalog.queries()[name](spark, sf_dir), connect(sf_dir), catalog.oracle_sql()[name]) == []


def test_an_attribute_of_the_calendar_prunes_day_folders(spark, sf_dir):
    lake = loading.loaded(spark, sf_dir, "by_day")
    sales, dates = lake.read(loading.SALES), lake.read("dim_date")
    sundays = metrics.sales_by_store(star.on_days(sales, dates, F.col("day_of_week") == "Sunday"))
    assert "dynamicpruning" in sundays._jdf.queryExecution().executedPlan().toString()
    days = sales.select("order_date").distinct().join(dates.where("day_of_week = 'Sunday'"), F.col("order_date") == F.col("date_key"))
    expected = days.count()
    assert expected < sales.select("order_date").distinct().count() / 6
    assert files_read(sundays, "total_amount") == expected


def days(spark, rows):
    return spark.createDataFrame(rows, "order_date date, order_id bigint, note string, amount double")


def some_days(n: int):
    return [(dt.date(2026, 1, 1 + k % 10), k, f"n{k % 7}" if k % 5 else None, k / 4) for k in range(n)]


def test_fingerprints_do_not_depend_on_order_and_see_copies_and_nulls(spark):
    rows = some_days(200)
    both = days(spark, rows), days(spark, rows[::-1]).repartition(7)
    one, two = (sorted(compare.fingerprints(f, "order_date").collect()) for f in both)
    assert one == two and sum(r.row_count for r in one) == 200
    base = (dt.date(2026, 2, 1), 1, "a", 1.0)
    for other in ((base[0], None, "a", 1.0), (base[0], 1, None, 1.0), (base[0], 1, "", 1.0), (base[0], 1, "a", None)):
        assert len(compare.differing(days(spark, [base]), days(spark, [other]), "order_date").collect()) == 1
    assert len(compare.differing(days(spark, [base] * 2), days(spark, [base]), "order_date").collect()) == 1
    assert compare.differing(days(spark, [base] * 2), days(spark, [base] * 2), "order_date").collect() == []
    # NULL stands where a value stood, and the values themselves are the same.
    swapped = spark.createDataFrame([(1, "x", None)], "d int, a string, b string"), spark.createDataFrame([(1, None, "x")], "d int, a string, b string")
    assert compare.differing(*swapped, "d").count() == 1


def test_only_days_that_differ_are_shuffled(spark):
    old = some_days(400) + [(None, 1, "none", 1.0)]
    new = [r for r in old if r[1] != 33] + [(dt.date(2026, 1, 7), 5000, "new", 0.0), (None, 2, "none", 2.0)]
    changes = compare.row_changes_within(days(spark, new), days(spark, old), "order_date")
    expected = compare.row_changes(days(spark, new), days(spark, old))
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(changes.collect(), key=key) == sorted(expected.collect(), key=key)
    assert changes.count() == 3
    # Two days of ten and the rows without one, on both sides, folded before the shuffle.
    assert rows_shuffled(changes) <= 2 * 2 * 40 + 3 < rows_shuffled(expected)
    assert compare.row_changes_within(days(spark, old), days(spark, old[::-1]), "order_date").collect() == []
    assert compare.row_changes_within(days(spark, []), days(spark, []), "order_date").collect() == []
    gone = compare.row_changes_within(days(spark, []), days(spark, old[:3]), "order_date").collect()
    assert sorted(r.copies for r in gone) == [-1, -1, -1]


@pytest.mark.parametrize("granularity", ["day", "month"])
def test_changes_of_an_overwrite_open_only_folders_that_differ(spark, lake, granularity):
    rows = [(dt.date(2026, 1 + k % 6, 1 + k % 3), k, f"n{k}", 1.0) for k in range(120)]
    lake.create(SALES, days(spark, []).schema, "order_date", granularity)
    lake.append(SALES, days(spark, rows))
    changed = [r if r[1] != 5 else (r[0], 5, "changed", 1.0) for r in rows]
    lake.overwrite(SALES, days(spark, changed))
    found = lake.changes(SALES, 1, 2)
    assert found.columns == ["order_date", "order_id", "note", "amount", "copies"]
    assert sorted((r.order_id, r.note, r.copies) for r in found.collect()) == [(5, "changed", 1), (5, "n5", -1)]
    assert files_read(found, "note") == 2


def test_partition_stats_come_from_footers(spark, lake, monkeypatch):
    rows = [(dt.date(2026, 1, 1 + k % 4) if k % 9 else None, k, f"n{k}", 1.0) for k in range(200)]
    more = [(dt.date(2026, 1, 1), -5, "x", 1.0), (dt.date(2026, 3, 1), 7, "x", 1.0)]
    lake.create(SALES, days(spark, []).schema, "order_date")
    lake.append(SALES, days(spark, rows))
    lake.append(SALES, days(spark, more))
    plans = []
    kind = type(spark.range(1).write)
    write = kind.parquet

    def noted(self, path, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        write(self, path, **options)

    monkeypatch.setattr(kind, "parquet", noted)

    def stats():
        return {tuple(r) for r in lake.partition_stats(SALES, ["order_id"]).collect()}

    def expected(all_rows):
        found = {}
        for day, order, *_ in all_rows:
            found.setdefault(day, []).append(order)
        ends = lambda orders: [f([o for o in orders if o is not None], default=None) for f in (min, max)]
        return {(day, len(orders), *ends(orders)) for day, orders in found.items()}

    assert stats() == expected(rows + more)
    assert len(plans) == 1 and "BatchScan" in plans[0] and "agg_func_0" in plans[0]
    # The footer of a file that holds only NULL has no ends: then the column itself is read.
    lake.append(SALES, days(spark, [(dt.date(2026, 4, 1), None, "x", 1.0)]))
    assert stats() == expected(rows + more + [(dt.date(2026, 4, 1), None)])


def test_partition_stats_refuse_what_footers_do_not_tell(spark, lake):
    lake.replace(SALES, days(spark, some_days(20)), "order_date")
    assert sum(r.record_count for r in lake.partition_stats(SALES).collect()) == 20
    with pytest.raises(ValueError, match="double"):
        lake.partition_stats(SALES, ["amount"])
    lake.rename_column(SALES, "order_id", "sale_id")
    with pytest.raises(ValueError, match="under this name"):
        lake.partition_stats(SALES, ["sale_id"])
    lake.replace("flat", days(spark, some_days(20)))
    assert [tuple(r) for r in lake.partition_stats("flat", ["order_id", "order_date"]).collect()] == [
        (None, 20, 0, 19, dt.date(2026, 1, 1), dt.date(2026, 1, 10))
    ]
