"""Joins of the sales fact with its dimensions.

No join carries a broadcast hint. Spark broadcasts a dimension when its measured
size is under `spark.sql.autoBroadcastJoinThreshold` and sort-merge joins it
otherwise, with adaptive execution splitting hot keys. Reports add sales up per
key before joining, so the join sees one row per key whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.metrics import top_products
from salesloom.operators.rollup import pre_aggregate, revenue, row_count


def star_join(
    sales: DataFrame, customer: DataFrame, product: DataFrame, store: DataFrame, date: DataFrame
) -> DataFrame:
    """Each sale with the attributes of its customer, product, store and date."""
    return (
        sales.join(product, "product_id")
        .join(store, "store_id")
        .join(date, sales["order_date"] == date["date_key"])
        .drop("date_key")
        .join(customer, "customer_id")
    )


def on_days(sales: DataFrame, date: DataFrame, condition: Column) -> DataFrame:
    """Sales of the days whose calendar attributes meet the condition.

    The days are few, so Spark broadcasts them, and where the sales are stored by day it reads the
    folders of just those days: which ones is found out while the query runs.
    """
    days = date.where(condition).select(F.col("date_key").alias("_day"))
    return sales.join(days, sales["order_date"] == days["_day"], "left_semi")


def revenue_by(
    sales: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str, attributes: list[str]
) -> DataFrame:
    """Sales rows, units and revenue per value of some attributes of one dimension."""
    per_key = pre_aggregate(sales, [fact_key]).withColumnRenamed(fact_key, "_key")
    looked_up = dimension.select(F.col(dim_key).alias("_key"), *attributes)
    joined = per_key.join(looked_up, "_key")
    return joined.groupBy(*attributes).agg(
        row_count(joined).alias("sales"),
        F.sum("quantity").alias("units"),
        revenue(joined).alias("revenue"),
    )


def revenue_by_product(sales: DataFrame, product: DataFrame, attributes: list[str]) -> DataFrame:
    out = revenue_by(sales, product, "product_id", "product_id", attributes)
    return out.orderBy(F.desc_nulls_last("revenue"), *attributes)


def revenue_by_store(sales: DataFrame, store: DataFrame, attributes: list[str]) -> DataFrame:
    out = revenue_by(sales, store, "store_id", "store_id", attributes)
    return out.orderBy(F.desc_nulls_last("revenue"), *attributes)


def sales_by_calendar(sales: DataFrame, date: DataFrame, attributes: list[str]) -> DataFrame:
    out = revenue_by(sales, date, "order_date", "date_key", attributes)
    return out.orderBy(*attributes)


def top_products_named(sales: DataFrame, product: DataFrame, limit: int) -> DataFrame:
    """Top products with their names.

    The names are first cut down to the products in question. The limit bounds
    that side, so Spark broadcasts it and the dimension is scanned in place.
    """
    top = top_products(sales, limit)
    names = product.select("product_id", "product_name", "category").join(
        top.select("product_id"), "product_id", "left_semi"
    )
    return top.join(names, "product_id", "left").orderBy(
        F.desc_nulls_last("revenue"), "product_id"
    )


def customer_activity(sales: DataFrame, customer: DataFrame) -> DataFrame:
    """Every customer with the number of sales and revenue, 0 and NULL where there is none."""
    totals = sales.groupBy("customer_id").agg(
        row_count(sales).alias("sales"), revenue(sales).alias("revenue")
    )
    return (
        customer.select("customer_id", "first_name", "last_name")
        .join(totals, "customer_id", "left")
        .withColumn("sales", F.coalesce("sales", F.lit(0).cast("bigint")))
    )


def customers_without_sales(sales: DataFrame, customer: DataFrame) -> DataFrame:
    buyers = sales.select("customer_id").distinct()
    return customer.join(buyers, "customer_id", "left_anti")
