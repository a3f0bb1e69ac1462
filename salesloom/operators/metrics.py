"""Metrics over the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.calendar import DateLike, as_date, previous_month, previous_weekend
from salesloom.functions.money import exact_avg
from salesloom.operators.partitions import where_range
from salesloom.operators.rollup import revenue, row_count


def checked_limit(n: int) -> int:
    if isinstance(n, bool) or not isinstance(n, int) or n < 0:
        raise ValueError(f"limit must be a whole number of 0 or more, got {n!r}")
    return n


def total_orders(sales: DataFrame) -> DataFrame:
    """Number of sales rows. It equals the number of orders where order_id is a key."""
    return sales.agg(row_count(sales).alias("total_orders"))


def top_products(sales: DataFrame, limit: int = 5) -> DataFrame:
    """Products with the highest revenue; equal revenue is ordered by product_id."""
    limit = checked_limit(limit)
    return (
        sales.groupBy("product_id")
        .agg(revenue(sales).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "product_id")
        .limit(limit)
    )


def sales_by_store(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("store_id")
        .agg(revenue(sales).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "store_id")
    )


def daily_sales(sales: DataFrame) -> DataFrame:
    """Sales rows per day, in date order."""
    return (
        sales.groupBy("order_date").agg(row_count(sales).alias("sales")).orderBy("order_date")
    )


def distinct_days(sales: DataFrame) -> DataFrame:
    return sales.agg(F.countDistinct("order_date").alias("distinct_days"))


def date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )


def sales_on_day(sales: DataFrame, day: DateLike) -> DataFrame:
    return sales.where(F.col("order_date") == as_date(day))


def sales_of_orders(sales: DataFrame, order_ids: list[int]) -> DataFrame:
    """Rows of one order or of a list of orders."""
    return sales.where(F.col("order_id").isin(*order_ids))


def top_products_last_month(sales: DataFrame, anchor: DateLike, limit: int = 5) -> DataFrame:
    return top_products(where_range(sales, "order_date", *previous_month(anchor)), limit)


def orders_last_weekend(sales: DataFrame, anchor: DateLike) -> DataFrame:
    return total_orders(where_range(sales, "order_date", *previous_weekend(anchor)))


def discount_summary(sales: DataFrame) -> DataFrame:
    """Rows with and without a discount. NULL means: written before the column existed."""
    discount = F.col("discount_applied")
    return sales.agg(
        F.count(discount).alias("rows_with_discount"),
        F.count_if(discount.isNull()).alias("rows_without_discount"),
        exact_avg(discount).alias("avg_discount"),
    )
