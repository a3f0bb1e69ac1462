"""Named questions with typed parameters, answered from the tables only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from salesloom.functions.calendar import previous_month, previous_weekend
from salesloom.operators import compare, metrics, star
from salesloom.tables.lake import Lake


@dataclass(frozen=True)
class Question:
    """A question, the tables that answer it, and its parameters as name -> (type, default)."""

    text: str
    sources: tuple[str, ...]
    parameters: dict[str, tuple[type, Any]]
    answer: Callable[..., DataFrame]


@dataclass(frozen=True)
class Answer:
    rows: DataFrame
    source: str


REQUIRED = object()
SALES = "fact_sales"


def _asof(lake: Lake, snapshot_id: int | None) -> DataFrame:
    return lake.read(SALES, snapshot_id)


QUESTIONS = {
    "total_orders": Question(
        "How many orders are there?",
        (SALES,),
        {},
        lambda lake: metrics.total_orders(lake.read(SALES)),
    ),
    "top_products": Question(
        "Which products have the highest revenue?",
        (SALES,),
        {"limit": (int, 5)},
        lambda lake, limit: metrics.top_products(lake.read(SALES), limit),
    ),
    "sales_by_store": Question(
        "What is the revenue of each store?",
        (SALES,),
        {},
        lambda lake: metrics.sales_by_store(lake.read(SALES)),
    ),
    "top_products_last_month": Question(
        "Which products had the highest revenue last month?",
        (SALES,),
        {"anchor": (dt.date, REQUIRED), "limit": (int, 5)},
        lambda lake, anchor, limit: metrics.top_products(
            lake.read(SALES, between=previous_month(anchor), on="order_date"), limit
        ),
    ),
    "orders_last_weekend": Question(
        "How many orders were placed last weekend?",
        (SALES,),
        {"anchor": (dt.date, REQUIRED)},
        lambda lake, anchor: metrics.total_orders(
            lake.read(SALES, between=previous_weekend(anchor), on="order_date")
        ),
    ),
    "daily_sales": Question(
        "How many orders were placed on each day?",
        (SALES,),
        {},
        lambda lake: metrics.daily_sales(lake.read(SALES)),
    ),
    "distinct_days": Question(
        "On how many days were orders placed?",
        (SALES,),
        {},
        lambda lake: metrics.distinct_days(lake.read(SALES)),
    ),
    "date_range": Question(
        "What are the first and the last order date?",
        (SALES,),
        {},
        lambda lake: metrics.date_range(lake.read(SALES)),
    ),
    "discount_summary": Question(
        "How many orders have a discount, and how high is it on average?",
        (SALES,),
        {},
        lambda lake: metrics.discount_summary(lake.read(SALES)),
    ),
    "revenue_by_category": Question(
        "What is the revenue of each product category?",
        (SALES, "dim_product"),
        {},
        lambda lake: star.revenue_by_product(
            lake.read(SALES), lake.read("dim_product"), ["category"]
        ),
    ),
    "revenue_by_location": Question(
        "What is the revenue of each store location?",
        (SALES, "dim_store"),
        {},
        lambda lake: star.revenue_by_store(
            lake.read(SALES), lake.read("dim_store"), ["location"]
        ),
    ),
    "sales_by_month": Question(
        "How did sales develop by month?",
        (SALES, "dim_date"),
        {},
        lambda lake: star.sales_by_calendar(
            lake.read(SALES), lake.read("dim_date"), ["year", "month"]
        ),
    ),
    "sales_by_weekday": Question(
        "On which weekdays do people buy?",
        (SALES, "dim_date"),
        {},
        lambda lake: star.sales_by_calendar(
            lake.read(SALES), lake.read("dim_date"), ["day_of_week"]
        ),
    ),
    "customer_activity": Question(
        "How much does each customer buy?",
        (SALES, "dim_customer"),
        {},
        lambda lake: star.customer_activity(lake.read(SALES), lake.read("dim_customer")),
    ),
    "customers_without_sales": Question(
        "Which customers never bought anything?",
        (SALES, "dim_customer"),
        {},
        lambda lake: star.customers_without_sales(lake.read(SALES), lake.read("dim_customer")),
    ),
    "snapshots": Question(
        "What changes were made to the sales table?",
        (f"{SALES}.snapshots",),
        {},
        lambda lake: lake.snapshots(SALES),
    ),
    "orders_now_vs_then": Question(
        "How many orders are there now, and how many at a snapshot?",
        (SALES,),
        {"snapshot_id": (int, REQUIRED)},
        lambda lake, snapshot_id: compare.now_vs_then(
            lake.read(SALES), _asof(lake, snapshot_id)
        ),
    ),
    "orders_days_ago": Question(
        "How many orders were there some days before a point in time?",
        (SALES,),
        {"now": (dt.datetime, REQUIRED), "days": (int, 3)},
        lambda lake, now, days: metrics.total_orders(
            lake.read(SALES, as_of=now - dt.timedelta(days=days))
        ),
    ),
}


def ask(lake: Lake, name: str, **arguments: Any) -> Answer:
    """The answer to a named question, with the tables it came from."""
    if name not in QUESTIONS:
        raise KeyError(f"unknown question {name!r}; known: {', '.join(sorted(QUESTIONS))}")
    question = QUESTIONS[name]
    unknown = set(arguments) - set(question.parameters)
    if unknown:
        raise TypeError(f"{name} does not take {', '.join(sorted(unknown))}")
    values = {}
    for parameter, (kind, default) in question.parameters.items():
        value = arguments.get(parameter, default)
        if value is REQUIRED:
            raise TypeError(f"{name} needs {parameter}")
        if not isinstance(value, kind) or isinstance(value, bool):
            raise TypeError(f"{parameter} must be of type {kind.__name__}, got {value!r}")
        values[parameter] = value
    sources = ", ".join(question.sources)
    snapshot = values.get("snapshot_id")
    if snapshot is not None:
        sources += f" (and its snapshot {snapshot})"
    return Answer(question.answer(lake, **values), sources)
