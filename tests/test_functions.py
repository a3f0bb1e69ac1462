from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from salesloom.functions.calendar import previous_month, previous_weekend
from salesloom.functions.cleaning import clean_nonfinite
from salesloom.functions.money import exact_avg
from salesloom.operators import metrics, star
from salesloom.operators.partitions import where_range
from salesloom.operators.rollup import pre_aggregate

SLOW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
NAN, INF = float("nan"), float("inf")


def test_periods_on_every_weekday_and_month_end(spark):
    days = [dt.date(2026, 2, 20) + dt.timedelta(days=i) for i in range(45)]
    frame = spark.createDataFrame([(d,) for d in days], "anchor date")
    found = frame.select(
        "anchor", *previous_weekend(F.col("anchor")), *previous_month(F.col("anchor"))
    ).collect()
    for anchor, saturday, monday, month, next_month in found:
        sunday = max(
            d for d in (anchor - dt.timedelta(days=i) for i in range(1, 8)) if d.weekday() == 6
        )
        assert (saturday, monday) == (
            sunday - dt.timedelta(days=1),
            sunday + dt.timedelta(days=1),
        )
        assert next_month == anchor.replace(day=1)
        assert month == (next_month - dt.timedelta(days=1)).replace(day=1)


def test_nonfinite_values_become_null_at_any_depth(spark):
    rows = [
        (1, NAN, [1.0, INF, None], {"a": -INF, "b": 2.0}, Row(x=NAN, y=[Row(z=1.5), Row(z=NAN)])),
        (None, 2.5, None, None, None),
    ]
    frame = spark.createDataFrame(
        rows,
        "id bigint, v double, list array<double>, named map<string,double>, "
        "rec struct<x:double,y:array<struct<z:double>>>",
    )
    cleaned = clean_nonfinite(frame)
    assert cleaned.columns == frame.columns
    bad, good = cleaned.collect()
    assert bad["v"] is None and bad["list"] == [1.0, None, None]
    assert bad["named"] == {"a": None, "b": 2.0}
    assert bad["rec"]["x"] is None and [r["z"] for r in bad["rec"]["y"]] == [1.5, None]
    assert good["id"] is None and good["v"] == 2.5
    assert good["list"] is None and good["named"] is None and good["rec"] is None


def test_cleaning_keeps_whole_numbers_and_repeated_names(spark):
    left = spark.createDataFrame([(1, NAN), (None, 1.0)], "id bigint, v double")
    right = spark.createDataFrame([(1, 3.0)], "id bigint, w double")
    joined = left.join(right, left["id"] == right["id"], "left")
    cleaned = clean_nonfinite(joined)
    assert cleaned.columns == ["id", "v", "id", "w"]
    assert cleaned.schema[0].dataType.simpleString() == "bigint"
    untouched = left.select("id")
    assert clean_nonfinite(untouched) is untouched


def sales(spark, rows):
    return spark.createDataFrame(
        rows, "product_id bigint, store_id bigint, quantity bigint, total_amount double"
    )


@SLOW
@given(
    amounts=st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 10**9)), min_size=1, max_size=60
    )
)
def test_revenue_is_exact(spark, amounts):
    rows = [(p, p % 2, 1, c / 100) for p, c in amounts]
    expected = {}
    for product, c in amounts:
        expected[product] = expected.get(product, Decimal(0)) + Decimal(c) / 100
    frame = sales(spark, rows)
    ranked = sorted(expected.items(), key=lambda kv: (-kv[1], kv[0]))
    direct = metrics.top_products(frame, 10).collect()
    folded = metrics.top_products(pre_aggregate(frame, ["product_id", "store_id"]), 10).collect()
    assert [(r["product_id"], r["revenue"]) for r in direct] == [
        (p, float(t)) for p, t in ranked
    ]
    assert direct == folded


def test_revenue_with_a_nonfinite_amount_is_null(spark):
    frame = sales(spark, [(1, 1, 1, NAN), (1, 1, 1, 2.0), (2, 1, 1, 3.0), (3, 1, 1, None)])
    for source in (frame, pre_aggregate(frame, ["product_id", "store_id"])):
        rows = {r["product_id"]: r["revenue"] for r in metrics.top_products(source, 9).collect()}
        assert rows == {1: None, 2: 3.0, 3: None}
        order = [r["product_id"] for r in metrics.top_products(source, 9).collect()]
        assert order == [2, 1, 3]


def test_too_large_a_total_is_an_error_and_not_a_wrong_number(spark):
    frame = sales(spark, [(1, 1, 1, 6e16), (1, 1, 1, 6e16)])
    with pytest.raises(Exception, match="OVERFLOW"):
        metrics.top_products(frame, 1).collect()


def test_average_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert frame.agg(exact_avg(F.col("v")).alias("a")).first()["a"] is None
    frame = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert math.isclose(frame.agg(exact_avg(F.col("v")).alias("a")).first()["a"], 0.15)


@pytest.mark.parametrize("limit", [-1, 2.5, True, "5"])
def test_limits_are_checked(spark, limit):
    with pytest.raises(ValueError):
        metrics.top_products(sales(spark, [(1, 1, 1, 1.0)]), limit)


def test_limit_zero_and_ties(spark):
    frame = sales(spark, [(3, 1, 1, 5.0), (1, 1, 1, 5.0), (2, 1, 1, 7.0)])
    assert metrics.top_products(frame, 0).count() == 0
    assert [r["product_id"] for r in metrics.top_products(frame, 5).collect()] == [2, 1, 3]


def test_empty_fact(spark):
    frame = sales(spark, [])
    assert metrics.total_orders(frame).first()["total_orders"] == 0
    folded = pre_aggregate(frame, ["product_id"])
    assert metrics.total_orders(folded).first()["total_orders"] == 0


def test_names_of_top_products_survive_a_missing_product(spark):
    frame = sales(spark, [(1, 1, 1, 5.0), (2, 1, 1, 7.0)])
    product = spark.createDataFrame(
        [(1, "one", "a", 1.0), (3, "three", "a", 1.0)],
        "product_id bigint, product_name string, category string, price double",
    )
    rows = star.top_products_named(frame, product, 2).collect()
    assert [(r["product_id"], r["product_name"]) for r in rows] == [(2, None), (1, "one")]


def test_range_on_a_timestamp_keeps_its_bounds(spark):
    stamps = [dt.datetime(2026, 1, 1, 23, 59), dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 3)]
    frame = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz").withColumn(
        "day", F.to_date("ts")
    )
    kept = where_range(frame, "ts", "2026-01-02", "2026-01-03", "day")
    assert [r["ts"] for r in kept.collect()] == [dt.datetime(2026, 1, 2)]
    kept = where_range(frame, "ts", "2026-01-01 12:00:00", "2026-01-02 00:00:01", "day")
    assert kept.count() == 2
    kept = where_range(
        frame.withColumn("month", F.trunc("ts", "MM")), "ts", "2026-01-02", "2026-01-09",
        "month", "month",
    )
    assert kept.count() == 2


def test_amounts_finer_than_cents_are_an_error(spark):
    from salesloom.functions.money import cents, from_cents

    total = lambda values, **k: spark.createDataFrame([(v,) for v in values], "v double").select(
        from_cents(F.sum(cents(F.col("v"), **k)), **k)
    ).first()[0]
    for value in (0.004, 0.125):
        with pytest.raises(Exception, match="more than 2 decimals"):
            total([value] * 3)
    assert total([0.125] * 1000, decimals=3) == 125.0
    assert total([0.29, 1.1, 19.99, 123456789.01]) == 123456810.39
    assert total([float("nan"), None, 1.5]) == 1.5


def test_whole_numbers_may_have_a_zero_fraction(spark):
    from pyspark.sql import types as T

    from salesloom.functions.text import rejected, typed

    frame = spark.createDataFrame([("5.0",), ("-7.",), ("5.5",), ("x",), (None,), (" 8 ",)], "a string")
    rows = frame.select(typed("a", T.LongType()), rejected("a", T.LongType()).alias("bad")).collect()
    assert [tuple(r) for r in rows] == [(5, False), (-7, False), (None, True), (None, True), (None, False), (8, False)]


def test_texts_with_letters_skip_the_cast(spark):
    """A failed cast costs far more than a look for letters; values and rejects stay as they were."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from salesloom.functions.text import parsed, rejected, typed

    assert "RLIKE" in str(parsed(F.col("a"), T.LongType())).upper()
    texts = [("P-12",), ("many",), ("1e3",), ("0x1F",), ("12L",), ("\t-4\n",), ("+3.00",), ("99999999999999999999",), ("",), (None,)]
    frame = spark.createDataFrame(texts, "a string")
    rows = frame.select(typed("a", T.LongType()), rejected("a", T.LongType()).alias("bad")).collect()
    assert [tuple(r) for r in rows] == [
        (None, True), (None, True), (None, True), (None, True), (None, True),
        (-4, False), (3, False), (None, True), (None, True), (None, False),
    ]
