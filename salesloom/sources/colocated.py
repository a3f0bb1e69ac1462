"""The star views over a stored layout in which lines and orders lie together.

Lines and orders are written once as tables bucketed by order, as many buckets on either side, one
file a bucket. Joining them then needs no exchange: bucket by bucket, a task reads the lines and
the orders of the same keys. What a shuffle pays at every query is paid at the load.

A bucket can't be cut at query time, so keys that would fill one alone don't go into them: lines of
orders with more lines than an average bucket, and lines without an order, are joined at the load
and stored as they come out, in files of any number. There are fewer such keys than buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.calendar import DateLike
from salesloom.operators.partitions import where_range
from salesloom.sources.star_views import StarViews

KEY = "order_id"
#: An order is kept in the buckets up to so many lines, however small an average bucket is.
ALWAYS_IN_BUCKETS = 10_000


class CoLocatedViews(StarViews):
    """Star views whose sales are read from the bucketed layout; dimensions come from `folder`.

    The layout's tables are named after `layout` in the session's catalog.
    """

    def __init__(self, spark: SparkSession, folder: str, layout: str):
        super().__init__(spark, folder)
        self.layout = layout

    @classmethod
    def write(
        cls, views: StarViews, layout: str, path: str, buckets: int, always: int = ALWAYS_IN_BUCKETS
    ) -> CoLocatedViews:
        """Stores the lines and orders of `views` below `path`; about 256 MB a bucket read well."""
        spark = views.spark
        lines, orders = views.lines(), views.orders()
        # One row per key is shuffled, and one per key above the limit stays.
        counted = lines.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
        average = lines.agg(F.count(F.lit(1))).scalar() / buckets
        hot = counted.where(F.col("n") > F.greatest(F.lit(always), F.ceil(average))).select(KEY)
        hot.write.parquet(f"{path}/hot")
        hot = spark.read.schema(hot.schema).parquet(f"{path}/hot")

        inside = lines.where(F.col(KEY).isNotNull()).join(hot, KEY, "left_anti")
        for name, rows in (("lines", inside), ("orders", orders)):
            # Spark's bucket of a key is its partition here, so each bucket is one file.
            dealt = rows.repartition(buckets, KEY)
            stored = dealt.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{path}/{name}")
            stored.saveAsTable(f"{layout}_{name}")
        apart = lines.where(F.col(KEY).isNull()).unionByName(lines.join(hot, KEY, "left_semi"))
        joined = apart.join(orders.join(hot, KEY, "left_semi"), KEY, "left")
        joined.hint("rebalance").write.option("path", f"{path}/apart").saveAsTable(f"{layout}_apart")
        return cls(spark, views.folder, layout)

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.layout}_{name}")

    def lines(self) -> DataFrame:
        inside = self._stored("lines")
        return inside.unionByName(self._stored("apart").select(*inside.columns))

    def orders(self, between: tuple[DateLike | None, DateLike | None] | None = None) -> DataFrame:
        orders = self._stored("orders")
        return orders if between is None else where_range(orders, "order_date", *between)

    def sales(self, between: tuple[DateLike | None, DateLike | None] | None = None) -> DataFrame:
        """The fact, as `StarViews.sales` has it, joined without an exchange of lines or orders."""
        how = "left" if between is None else "inner"
        # The hint keeps Spark from broadcasting orders where they are few: both sides lie ready.
        inside = self._stored("lines").join(self.orders(between).hint("merge"), KEY, how)
        apart = self._stored("apart")
        if between is not None:
            apart = where_range(apart, "order_date", *between)
        return inside.unionByName(apart).select(
            KEY,
            "order_date",
            "customer_id",
            "product_id",
            "store_id",
            "quantity",
            "total_amount",
            "discount_applied",
        )
