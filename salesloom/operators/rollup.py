"""Additive measures of sales, on single rows or on rows that were already added up.

`pre_aggregate` folds sales to one row per key. A key that holds a third of all
sales shrinks to one row per map task before anything is shuffled, and what is
joined afterwards is as small as the number of keys. It pays where rows per key
are many, as with products, stores and days. The measures below read either form,
so a metric does not care which one it is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.money import cents, from_cents, is_nonfinite

SALE_ROWS = "sale_rows"
CENTS = "amount_cents"
NONFINITE = "nonfinite_amount"


def is_pre_aggregated(sales: DataFrame) -> bool:
    return SALE_ROWS in sales.columns


def row_count(sales: DataFrame) -> Column:
    if is_pre_aggregated(sales):
        return F.coalesce(F.sum(SALE_ROWS), F.lit(0).cast("bigint"))
    return F.count(F.lit(1))


def _cents(sales: DataFrame) -> tuple[Column, Column]:
    if is_pre_aggregated(sales):
        return F.sum(CENTS), F.bool_or(NONFINITE)
    amount = F.col("total_amount")
    return F.sum(cents(amount)), F.bool_or(is_nonfinite(amount))


def revenue(sales: DataFrame) -> Column:
    """Sum of total_amount; NULL when an amount is NaN or infinite, as no total exists then."""
    total, nonfinite = _cents(sales)
    return F.when(~F.coalesce(nonfinite, F.lit(False)), from_cents(total))


def pre_aggregate(sales: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the row count, units and exact amount of its sales."""
    total, nonfinite = _cents(sales)
    return sales.groupBy(*keys).agg(
        row_count(sales).alias(SALE_ROWS),
        F.sum("quantity").alias("quantity"),
        total.alias(CENTS),
        nonfinite.alias(NONFINITE),
    )
