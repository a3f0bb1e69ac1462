"""The star schema as views over order, line, part, supplier and customer Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.calendar import DateLike
from salesloom.operators import generate
from salesloom.operators.partitions import where_range


class StarViews:
    """Each method reads only the base tables and columns that its view needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lines(self) -> DataFrame:
        """The fact without order date and customer: no join is needed for those metrics."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("l_discount").alias("discount_applied"),
        )

    def orders(self, between: tuple[DateLike | None, DateLike | None] | None = None) -> DataFrame:
        """Order id, date and customer; the range filters the stored timestamp, at the scan."""
        orders = self.table("orders")
        if between is not None:
            orders = where_range(orders, "o_orderdate", *between)
        return orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
        )

    def sales(self, between: tuple[DateLike | None, DateLike | None] | None = None) -> DataFrame:
        """The fact. A line without its order stays, with NULL date and customer.

        With a range only lines of orders in it remain, so unmatched lines drop out.

        Lines are joined as they are. Folding them per order first costs a third more
        time where an order's lines do not lie together, and a hot order needs no fold:
        adaptive execution splits the lines of its partition over several tasks.
        """
        how = "left" if between is None else "inner"
        joined = self.lines().join(self.orders(between), "order_id", how)
        return joined.select(
            "order_id",
            "order_date",
            "customer_id",
            "product_id",
            "store_id",
            "quantity",
            "total_amount",
            "discount_applied",
        )

    def customer(self) -> DataFrame:
        # A name without the sign has an empty last name.
        first, last = (F.split_part("c_name", F.lit("#"), F.lit(k)) for k in (1, 2))
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            first.alias("first_name"),
            last.alias("last_name"),
            F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
            F.lit(None).cast("date").alias("signup_date"),
        )

    def product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        )

    def store(self) -> DataFrame:
        """Suppliers as stores: the nation is the location, its region names the manager."""
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
        supplier = self.table("supplier")
        return supplier.join(
            places, supplier["s_nationkey"] == places["n_nationkey"], "left"
        ).select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("location"),
            F.concat(F.lit("Manager "), "r_name").alias("manager_name"),
        )

    def date(self) -> DataFrame:
        """One row per day from the first to the last order: as many as the calendar has."""
        span = self.table("orders").agg(
            F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi")
        )
        return generate.dates(span, F.col("lo"), F.col("hi"))

    def dimensions(self) -> dict[str, DataFrame]:
        return {
            "dim_customer": self.customer(),
            "dim_product": self.product(),
            "dim_store": self.store(),
            "dim_date": self.date(),
        }
