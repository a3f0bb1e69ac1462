"""The five tables of the star schema, their keys and their load order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


# The types that occur in the star schema.
TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def columns(ddl: str) -> T.StructType:
    """A flat schema from "name type, ..."; unlike Spark's parser it needs no session."""
    pairs = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class TableDef:
    name: str
    ddl: str
    primary_key: str
    # fact column -> (dimension table, dimension column)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return columns(self.ddl)


# Table, column and type names that the queries rely on.
DIM_CUSTOMER = TableDef(
    "dim_customer",
    "customer_id bigint, first_name string, last_name string, email string, signup_date date",
    "customer_id",
)
DIM_PRODUCT = TableDef(
    "dim_product",
    "product_id bigint, product_name string, category string, price double",
    "product_id",
)
DIM_STORE = TableDef(
    "dim_store",
    "store_id bigint, store_name string, location string, manager_name string",
    "store_id",
)
DIM_DATE = TableDef(
    "dim_date",
    "date_key date, day int, month int, year int, day_of_week string",
    "date_key",
)
FACT_SALES = TableDef(
    "fact_sales",
    "order_id bigint, order_date date, customer_id bigint, product_id bigint, "
    "store_id bigint, quantity bigint, total_amount double",
    "order_id",
    {
        "order_date": ("dim_date", "date_key"),
        "customer_id": ("dim_customer", "customer_id"),
        "product_id": ("dim_product", "product_id"),
        "store_id": ("dim_store", "store_id"),
    },
)
DISCOUNT_COLUMN = ("discount_applied", "double")

# Dimensions come before the fact that refers to them.
LOAD_ORDER = (DIM_CUSTOMER, DIM_PRODUCT, DIM_STORE, DIM_DATE, FACT_SALES)
TABLES = {table.name: table for table in LOAD_ORDER}
