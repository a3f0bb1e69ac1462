"""Loads of the star schema into lakes, each with another history.

A load is written once per session and source folder, and then shared by the
queries that read it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators import quality
from salesloom.plans.session import work_dir
from salesloom.schema import DISCOUNT_COLUMN, FACT_SALES, TABLES, columns
from salesloom.sources.colocated import CoLocatedViews
from salesloom.sources.csv import export_tables, read_strings, read_table, write_csv
from salesloom.sources.refresh import LakeSink, refresh_all
from salesloom.sources.star_views import StarViews
from salesloom.tables.lake import Lake

SALES = FACT_SALES.name

# The stages of the staged load: order dates in [low, high), and when they were committed.
# An open end takes all dates there are; rows without a date come with the last stage.
STAGES = (
    (None, "2000-01-01", dt.datetime(2026, 1, 10, 12)),
    ("2000-01-01", "2001-01-01", dt.datetime(2026, 1, 20, 12)),
    ("2001-01-01", None, dt.datetime(2026, 1, 30, 12)),
)
CREATED_AT = dt.datetime(2026, 1, 1, 12)
EVOLVED_AT = dt.datetime(2026, 1, 15, 12)

# The row that the edited load inserts: an order id that no source row has.
INSERTED_ORDER = -1
INSERTED_ROW = (INSERTED_ORDER, dt.date(2027, 3, 14), 3, 5, 2, 7, 351.75, 0.25)
KEPT_FROM = "2000-01-01"


def with_discount() -> T.StructType:
    return columns(f"{FACT_SALES.ddl}, {' '.join(DISCOUNT_COLUMN)}")


def staged(lake: Lake, views: StarViews) -> None:
    """Three appends; the discount column is added after the first."""
    for name, rows in views.dimensions().items():
        lake.replace(name, rows, committed_at=CREATED_AT)
    lake.create(SALES, FACT_SALES.schema, "order_date", "month", committed_at=CREATED_AT)
    for i, (low, high, at) in enumerate(STAGES):
        if i == 1:
            lake.add_column(SALES, *DISCOUNT_COLUMN, committed_at=EVOLVED_AT)
        if high is not None:
            rows = views.sales((low, high))
        else:
            rows = views.sales().where(F.col("order_date").isNull() | (F.col("order_date") >= low))
        lake.append(SALES, rows.select(*lake.state(SALES).schema.names), committed_at=at)


def edited(lake: Lake, views: StarViews) -> None:
    """All sales, then one inserted row, then an overwrite; and a product table with a renamed column."""
    lake.create(SALES, with_discount(), "order_date", "month", committed_at=CREATED_AT)
    lake.append(SALES, views.sales(), committed_at=STAGES[0][2])
    lake.insert(SALES, *INSERTED_ROW, committed_at=STAGES[1][2])
    lake.overwrite(SALES, views.sales((KEPT_FROM, None)), committed_at=STAGES[2][2])
    lake.replace("dim_product", views.product(), committed_at=CREATED_AT)
    lake.rename_column("dim_product", "price", "list_price", committed_at=EVOLVED_AT)


def by_day(lake: Lake, views: StarViews) -> None:
    """All sales in one append, one partition per day."""
    lake.create(SALES, with_discount(), "order_date", committed_at=CREATED_AT)
    lake.append(SALES, views.sales(), committed_at=STAGES[0][2])
    lake.replace("dim_date", views.date(), committed_at=CREATED_AT)


def by_hour(lake: Lake, views: StarViews) -> None:
    """All events, by the day of their time."""
    events = views.table("events")
    # The stored times have no zone; they are times in UTC.
    moment = F.timestamp_micros(F.unix_micros(F.to_timestamp_ltz(F.concat(F.col("ts").cast("string"), F.lit("Z")))))
    lake.replace("events", events.withColumn("ts", moment), "ts")


def load_csv_folder(lake: Lake, folder: str, suffix: str = "", exported: bool = False) -> None:
    """Refresh all tables from CSV files or folders named after them; sales by month."""
    typed = {
        name: read_table(lake.spark, f"{folder}/{name}{suffix}", table, exported)
        for name, table in TABLES.items()
    }
    refresh_all(typed, LakeSink(lake, {SALES: ("order_date", "month")}))


def through_csv(lake: Lake, views: StarViews) -> None:
    """Export every table to CSV and load the tables back from it."""
    folder = f"{lake.root}-csv"
    export_tables({**views.dimensions(), SALES: views.sales()}, folder, mode="overwrite")
    load_csv_folder(lake, folder, exported=True)


LOADS: dict[str, Callable[[Lake, StarViews], None]] = {
    "staged": staged,
    "edited": edited,
    "by_day": by_day,
    "by_hour": by_hour,
    "through_csv": through_csv,
}
_done: dict[tuple[str, str, str], Lake] = {}


def loaded(spark: SparkSession, folder: str, load: str) -> Lake:
    """The lake that a load makes of a source folder."""
    key = (spark.sparkContext.applicationId, folder, load)
    if key not in _done:
        lake = Lake(spark, work_dir(spark, load.replace("_", "-")))
        LOADS[load](lake, StarViews(spark, folder))
        _done[key] = lake
    return _done[key]


def colocated(spark: SparkSession, folder: str, buckets: int = 16) -> CoLocatedViews:
    """The star views of a source folder, over lines and orders stored by order."""
    key = (spark.sparkContext.applicationId, folder, "colocated")
    if key not in _done:
        path = work_dir(spark, "colocated")
        layout = path.rsplit("/", 1)[1].replace("-", "_")
        _done[key] = CoLocatedViews.write(StarViews(spark, folder), layout, path, buckets)
    return _done[key]


def flawed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as CSV text in which ids of pending orders and quantities over 40 do not parse."""
    key = (spark.sparkContext.applicationId, folder, "flawed")
    if key not in _done:
        views = StarViews(spark, folder)
        pending = (
            views.table("orders")
            .where("o_orderstatus = 'P'")
            .select(F.col("o_orderkey").alias("order_id"), F.lit(True).alias("pending"))
        )
        text = (
            views.sales()
            .join(pending, "order_id", "left")
            .withColumns(
                {
                    "order_id": F.when(
                        F.col("pending"), F.concat(F.lit("P-"), F.col("order_id").cast("string"))
                    ).otherwise(F.col("order_id").cast("string")),
                    "quantity": F.when(F.col("quantity") > 40, F.lit("many")).otherwise(
                        F.col("quantity").cast("string")
                    ),
                }
            )
            .drop("pending")
        )
        path = work_dir(spark, "flawed-csv")
        write_csv(text, path)
        _done[key] = path
    return read_strings(spark, _done[key], exported=True)


def loaded_with_rejects(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The flawed sales as loaded: typed rows, rejected rows, and counts of rejects by column."""
    key = (spark.sparkContext.applicationId, folder, "rejects")
    if key not in _done:
        path = work_dir(spark, "rejects")
        _done[key] = quality.load_with_rejects(flawed_orders(spark, folder), FACT_SALES, path)
    return _done[key]
