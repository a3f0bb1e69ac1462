"""Every query by name, with SQL that gives the same rows on the base tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.cleaning import clean_nonfinite
from salesloom.functions.text import typed
from salesloom.operators import compare, generate, metrics, partitions, quality, star
from salesloom.plans import loading
from salesloom.plans.gateway import ReadOnlySql
from salesloom.plans.loading import (
    INSERTED_ORDER,
    INSERTED_ROW,
    SALES,
    STAGES,
    flawed_orders,
    loaded,
    with_discount,
)
from salesloom.plans.questions import ask
from salesloom.plans.session import work_dir
from salesloom.schema import FACT_SALES, TABLES
from salesloom.sources.csv import read_strings, write_csv
from salesloom.sources.star_views import StarViews
from salesloom.tables.lake import Lake

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        ENTRIES[run.__name__] = Entry(run, sql)
        return run

    return register


def queries() -> dict[str, Query]:
    return {name: entry.run for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql is not None}


# The anchor of relative periods: the day of the last orders.
ANCHOR = "2001-08-01"
DAY, NEXT_DAY = "2000-01-01", "2000-01-02"
ORDER_IDS = [7, 123, 1_000_003]
EDITED_ORDER = 21

# The inserted row in SQL.
INSERTED_SQL = ", ".join(f"DATE '{v}'" if isinstance(v, dt.date) else str(v) for v in INSERTED_ROW)

# The star schema in SQL, for the equivalents below.
FACT = """
fact AS (
  SELECT l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
         l_partkey AS product_id, l_suppkey AS store_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS total_amount, l_discount AS discount_applied
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)"""
CUSTOMER = """
customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2)
           || '@example.com' AS email,
         CAST(NULL AS DATE) AS signup_date
  FROM customer
)"""
PRODUCT = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_retailprice AS price
  FROM part
)"""
STORE = """
stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS location,
         'Manager ' || r_name AS manager_name
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
)"""
DATE = """
dates AS (
  SELECT date_key, CAST(day(date_key) AS INTEGER) AS day, CAST(month(date_key) AS INTEGER) AS month,
         CAST(year(date_key) AS INTEGER) AS year, dayname(date_key) AS day_of_week
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_key
        FROM (SELECT CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) AS lo,
                     CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP) AS hi FROM orders))
)"""
REVENUE = "CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"
MEASURES = f"COUNT(*) AS sales, CAST(SUM(quantity) AS BIGINT) AS units, {REVENUE} AS revenue"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- metrics --------------------------------------------------------------


@query("SELECT COUNT(*) AS total_orders FROM lineitem")
def total_orders(spark, folder):
    return metrics.total_orders(StarViews(spark, folder).lines())


@query(
    _with(FACT)
    + f"SELECT product_id, {REVENUE} AS revenue FROM fact GROUP BY product_id "
    "ORDER BY revenue DESC NULLS LAST, product_id LIMIT 5"
)
def top_products(spark, folder):
    return metrics.top_products(StarViews(spark, folder).lines())


@query(
    _with(FACT, PRODUCT)
    + f"""SELECT t.product_id, revenue, product_name, category
FROM (SELECT product_id, {REVENUE} AS revenue FROM fact GROUP BY product_id
      ORDER BY revenue DESC NULLS LAST, product_id LIMIT 10) t
LEFT JOIN products p ON p.product_id = t.product_id"""
)
def top_products_named(spark, folder):
    views = StarViews(spark, folder)
    return star.top_products_named(views.lines(), views.product(), 10)


@query(_with(FACT) + f"SELECT store_id, {REVENUE} AS revenue FROM fact GROUP BY store_id")
def sales_by_store(spark, folder):
    return metrics.sales_by_store(StarViews(spark, folder).lines())


@query(_with(FACT) + "SELECT order_date, COUNT(*) AS sales FROM fact GROUP BY order_date")
def daily_sales(spark, folder):
    return metrics.daily_sales(StarViews(spark, folder).sales())


@query(_with(FACT) + "SELECT order_date, COUNT(*) AS sales FROM fact GROUP BY order_date")
def daily_sales_colocated(spark, folder):
    """Lines and orders stored by order: they are joined without an exchange."""
    return metrics.daily_sales(loading.colocated(spark, folder).sales())


@query(_with(FACT) + "SELECT COUNT(DISTINCT order_date) AS distinct_days FROM fact")
def distinct_days(spark, folder):
    return metrics.distinct_days(StarViews(spark, folder).sales())


@query(
    _with(FACT)
    + "SELECT MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date FROM fact"
)
def date_range(spark, folder):
    return metrics.date_range(StarViews(spark, folder).sales())


@query(_with(FACT) + f"SELECT * FROM fact WHERE order_date = DATE '{DAY}'")
def sales_on_day(spark, folder):
    return metrics.sales_on_day(StarViews(spark, folder).sales((DAY, NEXT_DAY)), DAY)


@query(_with(FACT) + f"SELECT * FROM fact WHERE order_id = {ORDER_IDS[0]}")
def sales_of_one_order(spark, folder):
    return metrics.sales_of_orders(StarViews(spark, folder).sales(), ORDER_IDS[:1])


@query(_with(FACT) + f"SELECT * FROM fact WHERE order_id IN ({', '.join(map(str, ORDER_IDS))})")
def orders_in_list(spark, folder):
    return metrics.sales_of_orders(StarViews(spark, folder).sales(), ORDER_IDS)


@query(
    _with(FACT)
    + f"""SELECT product_id, {REVENUE} AS revenue FROM fact
WHERE order_date >= DATE '2001-07-01' AND order_date < DATE '2001-08-01'
GROUP BY product_id ORDER BY revenue DESC NULLS LAST, product_id LIMIT 5"""
)
def top_products_last_month(spark, folder):
    views = StarViews(spark, folder)
    month = metrics.previous_month(ANCHOR)
    return metrics.top_products_last_month(views.sales(month), ANCHOR)


@query(
    _with(FACT)
    + "SELECT COUNT(*) AS total_orders FROM fact "
    "WHERE order_date IN (DATE '2001-07-28', DATE '2001-07-29')"
)
def orders_last_weekend(spark, folder):
    views = StarViews(spark, folder)
    weekend = metrics.previous_weekend(ANCHOR)
    return metrics.orders_last_weekend(views.sales(weekend), ANCHOR)


@query(
    """SELECT COUNT(l_discount) AS rows_with_discount,
       COUNT(*) - COUNT(l_discount) AS rows_without_discount,
       CAST(SUM(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT(l_discount), 0)
         AS avg_discount
FROM lineitem"""
)
def discount_summary(spark, folder):
    return metrics.discount_summary(StarViews(spark, folder).lines())


# -- star joins -----------------------------------------------------------


@query(
    _with(FACT, CUSTOMER, PRODUCT, STORE, DATE)
    + """SELECT f.*, product_name, category, price, store_name, location, manager_name,
       day, month, year, day_of_week, first_name, last_name, email, signup_date
FROM fact f JOIN products USING (product_id) JOIN stores USING (store_id)
     JOIN dates ON order_date = date_key JOIN customers USING (customer_id)"""
)
def star_join(spark, folder):
    views = StarViews(spark, folder)
    return star.star_join(
        views.sales(), views.customer(), views.product(), views.store(), views.date()
    )


@query(
    _with(FACT, CUSTOMER, PRODUCT, STORE, DATE)
    + """SELECT f.*, product_name, category, price, store_name, location, manager_name,
       day, month, year, day_of_week, first_name, last_name, email, signup_date
FROM fact f JOIN products USING (product_id) JOIN stores USING (store_id)
     JOIN dates ON order_date = date_key JOIN customers USING (customer_id)"""
)
def star_join_colocated(spark, folder):
    views = loading.colocated(spark, folder)
    return star.star_join(
        views.sales(), views.customer(), views.product(), views.store(), views.date()
    )


@query(
    _with(FACT, DATE)
    + f"""SELECT store_id, {REVENUE} AS revenue FROM fact JOIN dates ON order_date = date_key
WHERE day_of_week = 'Sunday' GROUP BY store_id"""
)
def sunday_sales_by_store(spark, folder):
    """A filter on an attribute of the calendar opens the folders of the Sundays only."""
    lake = loaded(spark, folder, "by_day")
    sundays = star.on_days(lake.read(SALES), lake.read("dim_date"), F.col("day_of_week") == "Sunday")
    return metrics.sales_by_store(sundays)


@query(
    _with(FACT, DATE)
    + f"""SELECT year, month, {MEASURES} FROM fact JOIN dates ON order_date = date_key
WHERE month = 12 AND day > 23 GROUP BY year, month"""
)
def december_sales(spark, folder):
    """Sales after the 23rd of December of each year, from the folders of those days."""
    lake = loaded(spark, folder, "by_day")
    dates = lake.read("dim_date")
    late = star.on_days(lake.read(SALES), dates, (F.col("month") == 12) & (F.col("day") > 23))
    return star.sales_by_calendar(late, dates, ["year", "month"])


@query(
    _with(FACT, PRODUCT)
    + f"SELECT category, {MEASURES} FROM fact JOIN products USING (product_id) GROUP BY category"
)
def revenue_by_category(spark, folder):
    views = StarViews(spark, folder)
    return star.revenue_by_product(views.lines(), views.product(), ["category"])


@query(
    _with(FACT, PRODUCT)
    + f"SELECT product_name, {MEASURES} FROM fact JOIN products USING (product_id) "
    "GROUP BY product_name"
)
def revenue_by_product_name(spark, folder):
    views = StarViews(spark, folder)
    return star.revenue_by_product(views.lines(), views.product(), ["product_name"])


@query(
    _with(FACT, STORE)
    + f"SELECT store_name, {MEASURES} FROM fact JOIN stores USING (store_id) GROUP BY store_name"
)
def revenue_by_store_name(spark, folder):
    views = StarViews(spark, folder)
    return star.revenue_by_store(views.lines(), views.store(), ["store_name"])


@query(
    _with(FACT, STORE)
    + f"SELECT location, {MEASURES} FROM fact JOIN stores USING (store_id) GROUP BY location"
)
def revenue_by_location(spark, folder):
    views = StarViews(spark, folder)
    return star.revenue_by_store(views.lines(), views.store(), ["location"])


@query(
    _with(FACT, STORE)
    + f"SELECT manager_name, {MEASURES} FROM fact JOIN stores USING (store_id) "
    "GROUP BY manager_name"
)
def revenue_by_manager(spark, folder):
    views = StarViews(spark, folder)
    return star.revenue_by_store(views.lines(), views.store(), ["manager_name"])


def _by_calendar(attributes: str) -> str:
    return (
        _with(FACT, DATE)
        + f"SELECT {attributes}, {MEASURES} FROM fact JOIN dates ON order_date = date_key "
        f"GROUP BY {attributes}"
    )


@query(_by_calendar("year, month"))
def sales_by_month(spark, folder):
    views = StarViews(spark, folder)
    return star.sales_by_calendar(views.sales(), views.date(), ["year", "month"])


@query(_by_calendar("year"))
def sales_by_year(spark, folder):
    views = StarViews(spark, folder)
    return star.sales_by_calendar(views.sales(), views.date(), ["year"])


@query(_by_calendar("day_of_week"))
def sales_by_weekday(spark, folder):
    views = StarViews(spark, folder)
    return star.sales_by_calendar(views.sales(), views.date(), ["day_of_week"])


@query(
    _with(FACT, CUSTOMER)
    + f"""SELECT c.customer_id, first_name, last_name, COUNT(order_id) AS sales, {REVENUE} AS revenue
FROM customers c LEFT JOIN fact f ON f.customer_id = c.customer_id
GROUP BY c.customer_id, first_name, last_name"""
)
def customer_activity(spark, folder):
    views = StarViews(spark, folder)
    return star.customer_activity(views.sales(), views.customer())


@query(
    _with(FACT, CUSTOMER)
    + "SELECT * FROM customers c "
    "WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.customer_id = c.customer_id)"
)
def customers_without_sales(spark, folder):
    views = StarViews(spark, folder)
    return star.customers_without_sales(views.sales(), views.customer())


# -- quality --------------------------------------------------------------


def _pk_sql(table: str, source: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name,
       COUNT(*) FILTER (WHERE k IS NOT NULL) AS repeated_keys,
       CAST(COALESCE(SUM(n) FILTER (WHERE k IS NOT NULL), 0) AS BIGINT) AS repeated_rows,
       CAST(COALESCE(SUM(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_rows
FROM (SELECT {key} AS k, COUNT(*) AS n FROM {source} GROUP BY {key}
      HAVING COUNT(*) > 1 OR {key} IS NULL)"""


@query(
    _with(DATE)
    + "\nUNION ALL ".join(
        [
            _pk_sql("dim_customer", "customer", "c_custkey"),
            _pk_sql("dim_product", "part", "p_partkey"),
            _pk_sql("dim_store", "supplier", "s_suppkey"),
            _pk_sql("dim_date", "dates", "date_key"),
            _pk_sql("fact_sales", "lineitem", "l_orderkey"),
        ]
    )
)
def pk_violations(spark, folder):
    views = StarViews(spark, folder)
    frames = {**views.dimensions(), SALES: views.lines()}
    return _stack(
        [quality.pk_summary(df, TABLES[name].primary_key, name) for name, df in frames.items()]
    )


@query(
    "SELECT l_orderkey AS key_value, COUNT(*) AS row_count FROM lineitem "
    "GROUP BY l_orderkey HAVING COUNT(*) > 1 OR l_orderkey IS NULL"
)
def repeated_order_ids(spark, folder):
    return quality.pk_violations(StarViews(spark, folder).lines(), "order_id")


def _fk_sql(fact_key: str, dim: str, fact: str, used: str, known: str, key: str) -> str:
    return f"""SELECT '{fact_key}' AS fact_key, '{dim}' AS dimension,
       COUNT(DISTINCT {used}) AS orphan_keys, COUNT(*) AS orphan_rows
FROM {fact} LEFT JOIN {known} ON {used} = {key}
WHERE {used} IS NOT NULL AND {key} IS NULL"""


# A calendar that is not made from the orders, so that orders can lie outside it.
CALENDAR, CALENDAR_DAYS = "1999-01-01", 731


@query(
    _with(
        FACT,
        f"""
calendar AS (SELECT DATE '{CALENDAR}' + CAST(d AS INTEGER) AS date_key FROM range({CALENDAR_DAYS}) AS r(d))""",
    )
    + "\nUNION ALL ".join(
        [
            _fk_sql("order_date", "dim_date", "fact", "order_date", "calendar", "date_key"),
            _fk_sql("customer_id", "dim_customer", "fact", "customer_id", "customer", "c_custkey"),
            _fk_sql("product_id", "dim_product", "fact", "product_id", "part", "p_partkey"),
            _fk_sql("store_id", "dim_store", "fact", "store_id", "supplier", "s_suppkey"),
            _fk_sql("order_id", "orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ]
    )
)
def fk_orphans(spark, folder):
    views = StarViews(spark, folder)
    dims = views.dimensions()
    dims["dim_date"] = generate.dates_of_year(spark, CALENDAR, CALENDAR_DAYS)
    # Product, store and order keys are on the lines; only date and customer need the order.
    return _stack(
        [
            quality.fk_report(
                views.lines(), {**dims, "orders": views.orders()}, FACT_SALES, {"order_id": ("orders", "order_id")}
            ),
            quality.fk_report(views.sales().select("order_date", "customer_id"), dims, FACT_SALES),
        ]
    )


@query(
    _with(FACT)
    + """SELECT COUNT(*) AS row_count, COUNT(DISTINCT order_date) AS distinct_days,
       MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date FROM fact"""
)
def load_profile(spark, folder):
    return quality.load_profile(StarViews(spark, folder).sales())


@query(
    """WITH flawed AS (
  SELECT COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS ids,
         COUNT(*) FILTER (WHERE l_quantity > 40) AS quantities
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)
SELECT 'order_id' AS column_name, 'bigint' AS target_type, ids AS rejects FROM flawed
UNION ALL SELECT 'quantity', 'bigint', quantities FROM flawed
UNION ALL SELECT 'order_date', 'date', 0
UNION ALL SELECT 'customer_id', 'bigint', 0
UNION ALL SELECT 'product_id', 'bigint', 0
UNION ALL SELECT 'store_id', 'bigint', 0
UNION ALL SELECT 'total_amount', 'double', 0"""
)
def cast_rejects(spark, folder):
    """Counted while the rows were loaded: the source is not read again."""
    _, _, counts = loading.loaded_with_rejects(spark, folder)
    return counts


@query(
    """SELECT 'order_id' AS column_name, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS rejects
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'quantity', COUNT(*) FILTER (WHERE l_quantity > 40) FROM lineitem"""
)
def cast_rejects_of_source(spark, folder):
    """Counted on the source itself, without a load."""
    counts = quality.cast_rejects(flawed_orders(spark, folder), FACT_SALES)
    return counts.where("rejects > 0 OR column_name IN ('order_id', 'quantity')").select("column_name", "rejects")


@query(
    """SELECT CASE WHEN o_orderstatus = 'P' THEN 'P-' ELSE '' END || CAST(l_orderkey AS VARCHAR)
         AS order_id,
       CASE WHEN l_quantity > 40 THEN 'many'
            ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
       CASE WHEN o_orderstatus = 'P' AND l_quantity > 40 THEN 'order_id,quantity'
            WHEN l_quantity > 40 THEN 'quantity' ELSE 'order_id' END AS rejected_columns
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'P' OR l_quantity > 40"""
)
def rejected_rows(spark, folder):
    """From the folder of a load that has written values and rejects in one pass."""
    _, rejects, _ = loading.loaded_with_rejects(spark, folder)
    return rejects.select(
        "order_id", "quantity", F.concat_ws(",", "rejected_columns").alias("rejected_columns")
    )


@query(
    """SELECT COUNT(*) AS row_count, COUNT(l_orderkey) FILTER (WHERE o_orderstatus IS DISTINCT FROM 'P') AS with_order_id,
       CAST(SUM(CASE WHEN l_quantity <= 40 THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS units
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""
)
def loaded_despite_rejects(spark, folder):
    rows, _, _ = loading.loaded_with_rejects(spark, folder)
    return rows.agg(
        F.count("*").alias("row_count"), F.count("order_id").alias("with_order_id"), F.sum("quantity").alias("units")
    )


@query(
    """SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
       CASE WHEN l_discount > 0 AND l_tax > 0 THEN l_extendedprice / l_discount END AS ratio,
       CASE WHEN l_discount > 0 AND l_tax > 0 THEN l_extendedprice / l_discount END AS in_array,
       CASE WHEN l_discount > 0 AND l_tax > 0 THEN l_extendedprice / l_discount END AS in_struct,
       CASE WHEN l_discount > 0 AND l_tax > 0 THEN l_extendedprice / l_discount END AS in_map,
       l_tax AS finite
FROM lineitem"""
)
def nonfinite_to_null(spark, folder):
    lines = StarViews(spark, folder).table("lineitem")
    ratio = (
        F.when(F.col("l_discount") > 0, F.try_divide("l_extendedprice", "l_discount"))
        .when(F.col("l_tax") > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    ratio = F.when(F.col("l_tax") > 0, ratio).otherwise(F.lit(float("nan")))
    nested = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        ratio.alias("ratio"),
        F.array(F.col("l_tax"), ratio).alias("values"),
        F.struct(ratio.alias("inner")).alias("record"),
        F.create_map(F.lit("ratio"), ratio).alias("named"),
        F.col("l_tax").alias("finite"),
    )
    return clean_nonfinite(nested).select(
        "order_id",
        "line",
        "product_id",
        "ratio",
        F.col("values")[1].alias("in_array"),
        F.col("record.inner").alias("in_struct"),
        F.col("named")["ratio"].alias("in_map"),
        "finite",
    )


# -- CSV and refresh ------------------------------------------------------


@query(
    _with(DATE)
    + """SELECT 'dim_customer' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM part
UNION ALL SELECT 'dim_store', COUNT(*) FROM supplier
UNION ALL SELECT 'dim_date', COUNT(*) FROM dates
UNION ALL SELECT 'fact_sales', COUNT(*) FROM lineitem"""
)
def refreshed_tables(spark, folder):
    lake = loaded(spark, folder, "through_csv")
    return _stack(
        [
            lake.read(name).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
            )
            for name in TABLES
        ]
    )


@query(_with(FACT) + "SELECT * EXCLUDE (discount_applied) FROM fact")
def csv_round_trip(spark, folder):
    return loaded(spark, folder, "through_csv").read(SALES)


@query(_with(STORE) + "SELECT * FROM stores")
def csv_round_trip_stores(spark, folder):
    return loaded(spark, folder, "through_csv").read("dim_store")


@query("SELECT conv_id, turn, role, text FROM conversations")
def csv_blocks_round_trip(spark, folder):
    """The same, with records found block by block, as in files too large for a task."""
    rows = StarViews(spark, folder).table("conversations").select("conv_id", "turn", "role", "text")
    path = work_dir(spark, "csv-blocks-text")
    write_csv(rows, path)
    back = read_strings(spark, path, exported=True, split_from=0)
    return back.select(*[typed(f.name, f.dataType) for f in rows.schema.fields])


@query("SELECT conv_id, turn, role, text FROM conversations")
def csv_text_round_trip(spark, folder):
    """Texts with blanks, line breaks and quotes, written as CSV and read back."""
    rows = StarViews(spark, folder).table("conversations").select("conv_id", "turn", "role", "text")
    path = work_dir(spark, "csv-text")
    write_csv(rows, path)
    back = read_strings(spark, path, exported=True)
    return back.select(*[typed(f.name, f.dataType) for f in rows.schema.fields])


# -- partitions -----------------------------------------------------------


@query(_with(FACT) + "SELECT DISTINCT order_date AS partition, CAST(1 AS BIGINT) AS files FROM fact")
def files_per_day(spark, folder):
    return partitions.files_per_partition(loaded(spark, folder, "by_day").files(SALES))


@query(
    _with(FACT)
    + "SELECT order_date AS partition, COUNT(*) AS record_count, CAST(1 AS BIGINT) AS files "
    "FROM fact GROUP BY order_date"
)
def file_record_counts(spark, folder):
    """Rows from the footers, files from the listing: no row group is opened."""
    lake = loaded(spark, folder, "by_day")
    rows, files = lake.partition_stats(SALES), partitions.files_per_partition(lake.files(SALES))
    same = rows["partition"].eqNullSafe(files["partition"])
    return rows.join(files, same).select(rows["partition"], "record_count", "files")


@query(
    _with(FACT)
    + """SELECT order_date AS partition, COUNT(*) AS record_count, MIN(product_id) AS least_product_id,
       MAX(product_id) AS largest_product_id, MIN(quantity) AS least_quantity, MAX(quantity) AS largest_quantity
FROM fact GROUP BY order_date"""
)
def partition_ranges(spark, folder):
    """Least and largest values of each day, from footers."""
    return loaded(spark, folder, "by_day").partition_stats(SALES, ["product_id", "quantity"])


@query(
    _with(FACT)
    + f"""SELECT COUNT(DISTINCT order_date) + CAST(COUNT(*) > COUNT(order_date) AS BIGINT)
         AS partitions_total,  -- rows without a date are a partition too
       COUNT(DISTINCT order_date) FILTER (WHERE order_date = DATE '{DAY}') AS partitions_matched,
       COUNT(*) FILTER (WHERE order_date = DATE '{DAY}') AS rows_matched FROM fact"""
)
def pruning_report(spark, folder):
    return loaded(spark, folder, "by_day").pruning_report(SALES, DAY, NEXT_DAY)


@query(_with(FACT) + f"SELECT * FROM fact WHERE order_date = DATE '{DAY}'")
def pruned_day(spark, folder):
    return metrics.sales_on_day(loaded(spark, folder, "by_day").read(SALES), DAY)


@query(
    _with(FACT)
    + "SELECT * FROM fact WHERE order_date >= DATE '2000-03-15' AND order_date < DATE '2000-05-02'"
)
def pruned_months(spark, folder):
    return loaded(spark, folder, "edited").read(
        SALES, snapshot_id=1, between=("2000-03-15", "2000-05-02")
    )


@query(
    """SELECT event_id, epoch_us(ts) AS at_micros, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-02 06:00:00' AND ts < TIMESTAMP '2024-01-05 18:30:00'"""
)
def pruned_timestamps(spark, folder):
    """A range of a timestamp column that is partitioned by its day in UTC."""
    lake = loaded(spark, folder, "by_hour")
    between = ("2024-01-02T06:00:00Z", "2024-01-05T18:30:00Z")
    rows = lake.read("events", between=between)
    return rows.select("event_id", F.unix_micros("ts").alias("at_micros"), "event_type")


@query(
    _with(FACT)
    + """SELECT order_date AS "partition", COUNT(*) AS record_count, CAST(1 AS BIGINT) AS files
FROM fact GROUP BY order_date"""
)
def readonly_sql_files(spark, folder):
    return ReadOnlySql(loaded(spark, folder, "by_day")).run(
        """
        SELECT partition, SUM(record_count) AS record_count, COUNT(file_path) AS files
        FROM local.db.fact_sales.files GROUP BY partition ORDER BY partition
        """
    )


# -- versions -------------------------------------------------------------

STAGED = """
staged AS (
  SELECT order_id, order_date, customer_id, product_id, store_id, quantity, total_amount,
         CASE WHEN order_date < DATE '2000-01-01' THEN NULL ELSE discount_applied END
           AS discount_applied,
         CASE WHEN order_date < DATE '2000-01-01' THEN 1
              WHEN order_date < DATE '2001-01-01' THEN 2 ELSE 3 END AS stage
  FROM fact
)"""
STAGED_COLUMNS = "* EXCLUDE (stage)"


@query(_with(FACT, STAGED) + f"SELECT {STAGED_COLUMNS} FROM staged")
def current_table(spark, folder):
    return loaded(spark, folder, "staged").read(SALES)


@query(
    _with(FACT, STAGED)
    + """SELECT CAST(v AS BIGINT) AS snapshot_id, COUNT(*) AS orders
FROM staged JOIN (VALUES (1), (2), (3)) AS versions(v) ON stage <= v GROUP BY v"""
)
def asof_count(spark, folder):
    lake = loaded(spark, folder, "staged")
    return _stack(
        [
            lake.read(SALES, snapshot_id=v).agg(
                F.lit(v).cast("bigint").alias("snapshot_id"), F.count(F.lit(1)).alias("orders")
            )
            for v in (1, 2, 3)
        ]
    )


@query(
    _with(FACT, STAGED)
    + "SELECT * EXCLUDE (stage, discount_applied) FROM staged "
    "WHERE stage <= 1 AND order_date = DATE '1999-12-31'"
)
def asof_filtered(spark, folder):
    lake = loaded(spark, folder, "staged")
    return metrics.sales_on_day(lake.read(SALES, snapshot_id=1), "1999-12-31")


@query(
    _with(FACT, STAGED)
    + "SELECT COUNT(*) AS total_orders FROM staged WHERE stage <= 2"
)
def asof_timestamp_count(spark, folder):
    # Three days before the last commit, the second stage was the latest.
    lake = loaded(spark, folder, "staged")
    return ask(lake, "orders_days_ago", now=STAGES[2][2], days=3).rows


@query(
    _with(FACT, STAGED)
    + """SELECT COUNT(*) AS current_orders, COUNT(*) FILTER (WHERE stage <= 1) AS old_orders
FROM staged"""
)
def now_vs_then(spark, folder):
    return ask(loaded(spark, folder, "staged"), "orders_now_vs_then", snapshot_id=1).rows


@query(
    _with(FACT)
    + f"SELECT COUNT(*) + 1 AS current_orders, COUNT(*) AS old_orders FROM fact "
    f"WHERE order_id = {INSERTED_ORDER}"
)
def row_presence(spark, folder):
    lake = loaded(spark, folder, "edited")
    return compare.presence(
        lake.read(SALES, snapshot_id=2), lake.read(SALES, snapshot_id=1), INSERTED_ORDER
    )


@query(_with(FACT, STAGED) + f"SELECT {STAGED_COLUMNS} FROM staged WHERE stage > 1")
def rows_added(spark, folder):
    return loaded(spark, folder, "staged").added_since(SALES, 1)


@query(
    _with(FACT)
    + f"""SELECT order_id, order_date, customer_id, product_id, store_id, quantity, total_amount,
       discount_applied, CAST(-COUNT(*) AS BIGINT) AS copies
FROM (SELECT * FROM fact WHERE order_date IS NULL OR order_date < DATE '2000-01-01'
      UNION ALL SELECT {INSERTED_SQL})
GROUP BY ALL"""
)
def row_changes(spark, folder):
    lake = loaded(spark, folder, "edited")
    return compare.row_changes(lake.read(SALES), lake.read(SALES, snapshot_id=2))


@query(
    _with(FACT)
    + f"""SELECT order_id, order_date, customer_id, product_id, store_id, quantity, total_amount,
       discount_applied, CAST(-COUNT(*) AS BIGINT) AS copies
FROM (SELECT * FROM fact WHERE order_date IS NULL OR order_date < DATE '2000-01-01'
      UNION ALL SELECT {INSERTED_SQL})
GROUP BY ALL"""
)
def changes_of_overwrite(spark, folder):
    """An overwrite keeps most days: months with equal fingerprints are not shuffled."""
    return loaded(spark, folder, "edited").changes(SALES, 2, 3)


@query(
    _with(FACT)
    + """SELECT order_date AS day, COUNT(*) AS row_count FROM fact GROUP BY order_date"""
)
def day_fingerprints(spark, folder):
    """Days of the by-day table whose fingerprints equal those of the source rows."""
    stored = compare.fingerprints(loaded(spark, folder, "by_day").read(SALES), "order_date")
    source = compare.fingerprints(StarViews(spark, folder).sales(), "order_date", with_discount().names)
    return stored.join(
        source, [stored[c].eqNullSafe(source[c]) for c in stored.columns], "left_semi"
    ).select(F.col("order_date").alias("day"), "row_count")


@query(
    _with(FACT)
    + f"""SELECT * FROM fact WHERE order_id IN ({EDITED_ORDER})
UNION ALL SELECT {INSERTED_SQL}"""
)
def inserted_row(spark, folder):
    lake = loaded(spark, folder, "edited")
    return metrics.sales_of_orders(lake.read(SALES, snapshot_id=2), [EDITED_ORDER, INSERTED_ORDER])


@query(
    _with(FACT)
    + """SELECT CAST(1 AS BIGINT) AS snapshot_id, 'append' AS operation, COUNT(*) AS orders FROM fact
UNION ALL SELECT 2, 'append', COUNT(*) + 1 FROM fact
UNION ALL SELECT 3, 'overwrite', COUNT(*) FROM fact WHERE order_date >= DATE '2000-01-01'"""
)
def overwrite_history(spark, folder):
    lake = loaded(spark, folder, "edited")
    counts = _stack(
        [
            lake.read(SALES, snapshot_id=v).agg(
                F.lit(v).cast("bigint").alias("snapshot_id"), F.count(F.lit(1)).alias("orders")
            )
            for v in (1, 2, 3)
        ]
    )
    history = lake.snapshots(SALES).select("snapshot_id", "operation")
    return history.join(counts, "snapshot_id")


@query(
    _with(FACT, STAGED)
    + """SELECT stage > 1 AS written_with_column, COUNT(*) AS row_count,
       COUNT(discount_applied) AS with_discount
FROM staged GROUP BY stage > 1"""
)
def evolved_nulls(spark, folder):
    sales = loaded(spark, folder, "staged").read(SALES)
    # Rows without a date were loaded last.
    later = F.coalesce(F.col("order_date") >= "2000-01-01", F.lit(True))
    return sales.groupBy(later.alias("written_with_column")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("discount_applied").alias("with_discount")
    )


@query(
    _with(FACT, STAGED)
    + """SELECT CAST(v AS BIGINT) AS snapshot_id, CASE WHEN v > 1 THEN CAST(v - 1 AS BIGINT) END AS parent_id,
       'append' AS operation, CAST(CASE WHEN v = 1 THEN 0 ELSE 1 END AS INTEGER) AS schema_id,
       COUNT(*) FILTER (WHERE stage = v) AS added_records, COUNT(*) AS total_records,
       COUNT(DISTINCT CASE WHEN stage = v THEN coalesce(date_trunc('month', order_date), DATE '0001-01-01') END)
         AS changed_partitions
FROM staged JOIN (VALUES (1), (2), (3)) AS versions(v) ON stage <= v GROUP BY v"""
)
def snapshot_history(spark, folder):
    def count(key: str):
        return F.col("summary")[key].cast("bigint")

    return loaded(spark, folder, "staged").snapshots(SALES).select(
        "snapshot_id",
        "parent_id",
        "operation",
        "schema_id",
        count("added-records").alias("added_records"),
        count("total-records").alias("total_records"),
        count("changed-partition-count").alias("changed_partitions"),
    )


FACT_COLUMNS = [
    ("order_id", "bigint"), ("order_date", "date"), ("customer_id", "bigint"),
    ("product_id", "bigint"), ("store_id", "bigint"), ("quantity", "bigint"),
    ("total_amount", "double"), ("discount_applied", "double"),
]


def _schema_history_sql() -> str:
    rows = [
        f"({schema}, {i}, {i + 1}, '{name}', '{kind}')"
        for schema, width in ((0, 7), (1, 8))
        for i, (name, kind) in enumerate(FACT_COLUMNS[:width])
    ]
    return _with(FACT, STAGED) + (
        f"SELECT t.*, (SELECT COUNT(*) FROM staged WHERE (stage > 1) = (schema_id = 1)) AS rows_written "
        f"FROM (VALUES {', '.join(rows)}) AS t(schema_id, ordinal, field_id, name, type)"
    )


@query(_schema_history_sql())
def schema_history(spark, folder):
    """Each schema of the table beside the rows written under it, counted in the rows themselves."""
    lake = loaded(spark, folder, "staged")
    versions = lake.snapshots(SALES).select("snapshot_id", "schema_id")
    written = _stack(
        [
            rows.agg(F.lit(v).cast("bigint").alias("snapshot_id"), F.count(F.lit(1)).alias("n"))
            for v, rows in ((1, lake.read(SALES, 1)), (2, lake.added_since(SALES, 1, 2)), (3, lake.added_since(SALES, 2, 3)))
        ]
    )
    totals = versions.join(written, "snapshot_id").groupBy("schema_id").agg(F.sum("n").alias("rows_written"))
    return lake.schema_history(SALES).join(totals, "schema_id", "left")


@query(
    "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, "
    "p_retailprice AS list_price FROM part"
)
def rename_by_field_id(spark, folder):
    return loaded(spark, folder, "edited").read("dim_product")


@query(
    """SELECT * FROM (
  SELECT 1 AS step, 'created twice' AS what, TRUE AS "exists", COUNT(*) AS row_count FROM supplier
  UNION ALL SELECT 2, 'dropped', FALSE, 0
  UNION ALL SELECT 3, 'created anew', TRUE, COUNT(*) FROM supplier WHERE s_acctbal >= 0)"""
)
def table_life(spark, folder):
    """Create if absent, drop, and create again with other rows under the same name."""
    lake = Lake(spark, work_dir(spark, "life"))
    rows = StarViews(spark, folder).table("supplier")
    steps = []

    def note(what: str) -> None:
        there = lake.exists("suppliers")
        count = lake.read("suppliers") if there else rows.limit(0)
        steps.append(
            count.agg(
                F.lit(len(steps) + 1).alias("step"), F.lit(what).alias("what"), F.lit(there).alias("exists"),
                F.count(F.lit(1)).alias("row_count"),
            )
        )

    lake.create("suppliers", rows.schema)
    lake.append("suppliers", rows)
    lake.create("suppliers", "other int", if_not_exists=True)
    note("created twice")
    lake.drop("suppliers")
    lake.drop("suppliers", if_exists=True)
    note("dropped")
    lake.create("suppliers", rows.schema)
    lake.append("suppliers", rows.where("s_acctbal >= 0"))
    note("created anew")
    return _stack(steps)


# -- SQL, listings and questions ------------------------------------------


@query(
    _with(FACT, STAGED, PRODUCT)
    + """SELECT category, 'drop; a note' AS remark, COUNT(*) AS sales
FROM staged JOIN products USING (product_id) GROUP BY category"""
)
def readonly_sql(spark, folder):
    return ReadOnlySql(loaded(spark, folder, "staged")).run(
        """
        SELECT p.category, 'drop; a note' AS remark, COUNT(*) AS sales  -- no update here
        FROM local.db.fact_sales f JOIN local.db.dim_product p ON p.product_id = f.product_id
        GROUP BY p.category
        """
    )


@query(
    _with(FACT, STAGED)
    + "SELECT COUNT(*) AS total_orders FROM staged WHERE stage <= 2"
)
def readonly_sql_version(spark, folder):
    return ReadOnlySql(loaded(spark, folder, "staged")).run(
        "SELECT COUNT(*) AS total_orders FROM local.db.fact_sales VERSION AS OF 2"
    )


@query(
    _with(FACT, STAGED)
    + """SELECT CAST(v AS BIGINT) AS snapshot_id, 'append' AS operation, COUNT(*) AS added
FROM staged JOIN (VALUES (1), (2), (3)) AS versions(v) ON stage = v GROUP BY v"""
)
def readonly_sql_snapshots(spark, folder):
    return ReadOnlySql(loaded(spark, folder, "staged")).run(
        "SELECT snapshot_id, operation, CAST(summary['added-records'] AS BIGINT) AS added "
        "FROM local.db.fact_sales.snapshots"
    )


@query(
    _with(FACT, STAGED)
    + "SELECT COUNT(*) AS total_orders, MAX(order_date) AS last_day FROM staged WHERE stage <= 1"
)
def snapshot_sql(spark, folder):
    return ReadOnlySql(loaded(spark, folder, "staged")).run_at(
        1,
        "SELECT COUNT(*) AS total_orders, MAX(order_date) AS last_day FROM local.db.fact_sales",
    )


@query(
    _with(DATE)
    + """SELECT 'db' AS namespace, t AS "tableName", FALSE AS "isTemporary", n AS row_count
FROM (SELECT 'dim_customer' AS t, COUNT(*) AS n FROM customer UNION ALL SELECT 'dim_product', COUNT(*) FROM part
      UNION ALL SELECT 'dim_store', COUNT(*) FROM supplier UNION ALL SELECT 'dim_date', COUNT(*) FROM dates
      UNION ALL SELECT 'fact_sales', COUNT(*) FROM lineitem)"""
)
def table_listing(spark, folder):
    """SHOW TABLES beside the rows of each table."""
    lake = loaded(spark, folder, "staged")
    counts = _stack(
        [lake.read(name).agg(F.lit(name).alias("tableName"), F.count(F.lit(1)).alias("row_count")) for name in TABLES]
    )
    return ReadOnlySql(lake).run("SHOW TABLES IN local.db").join(counts, "tableName", "left")


# The tables of the staged load in SQL.
SOURCES = {
    "dim_customer": "customers", "dim_product": "products", "dim_store": "stores", "dim_date": "dates", SALES: "staged",
}


def _schema_info_sql() -> str:
    parts = [
        f"SELECT '{table.name}' AS table_name, {i} AS ordinal, '{f.name}' AS column_name, "
        f"'{f.dataType.simpleString()}' AS data_type, CAST(NULL AS VARCHAR) AS error, "
        f"COUNT({f.name}) AS filled FROM {SOURCES[table.name]}"
        for table in TABLES.values()
        for i, f in enumerate(
            (loading.with_discount() if table.name == SALES else table.schema).fields, start=1
        )
    ]
    return _with(FACT, STAGED, CUSTOMER, PRODUCT, STORE, DATE) + " UNION ALL ".join(parts)


@query(_schema_info_sql())
def schema_info(spark, folder):
    """Columns and types beside the number of values in each column."""
    lake = loaded(spark, folder, "staged")
    filled = []
    for name in TABLES:
        rows = lake.read(name)
        counts = rows.agg(*[F.count(F.col(c)).alias(c) for c in rows.columns])
        filled.append(
            counts.select(F.lit(name).alias("table_name"), F.explode(
                F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in rows.columns])
            ).alias("c")).select("table_name", "c.*")
        )
    return lake.schema_info(list(TABLES)).join(_stack(filled), ["table_name", "column_name"], "left")


@query(
    _with(FACT, STAGED)
    + f"SELECT product_id, {REVENUE} AS revenue FROM staged GROUP BY product_id "
    "ORDER BY revenue DESC NULLS LAST, product_id LIMIT 3"
)
def named_question(spark, folder):
    return ask(loaded(spark, folder, "staged"), "top_products", limit=3).rows


# -- generation -----------------------------------------------------------


@query(_with(DATE) + "SELECT * FROM dates")
def date_dimension(spark, folder):
    return StarViews(spark, folder).date()


def _hash_sql(key: str, salt: int, bound: int | str) -> str:
    digest = f"md5(CAST({key} AS VARCHAR) || ':{salt}')"
    return f"(CAST('0x' || substr({digest}, 1, {generate.HASH_DIGITS}) AS BIGINT) % {bound})"


def _pick_sql(key: str, salt: int, words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"([{listed}])[1 + CAST({_hash_sql(key, salt, len(words))} AS INTEGER)]"


def _generated_customers_sql() -> str:
    first = _pick_sql("c_custkey", 1, generate.FIRST_NAMES)
    last = _pick_sql("c_custkey", 2, generate.LAST_NAMES)
    return f"""SELECT c_custkey AS customer_id, {first} AS first_name, {last} AS last_name,
       lower({first} || '.' || {last}) || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       DATE '{ANCHOR}' - CAST({_hash_sql("c_custkey", 3, 731)} AS INTEGER) AS signup_date
FROM customer"""


@query(_generated_customers_sql())
def generated_customers(spark, folder):
    ids = StarViews(spark, folder).table("customer").select("c_custkey")
    return generate.customers(ids, ANCHOR, "c_custkey")


@query(
    f"""SELECT p_partkey AS product_id,
       upper({_pick_sql("p_partkey", 1, generate.PRODUCT_WORDS)}[1])
         || substr({_pick_sql("p_partkey", 1, generate.PRODUCT_WORDS)}, 2) || ' '
         || {_pick_sql("p_partkey", 2, generate.PRODUCT_NOUNS)} AS product_name,
       {_pick_sql("p_partkey", 3, generate.CATEGORIES)} AS category,
       CAST(({_hash_sql("p_partkey", 4, 49001)} + 1000) / 100.0 AS DOUBLE) AS price
FROM part"""
)
def generated_products(spark, folder):
    ids = StarViews(spark, folder).table("part").select("p_partkey")
    return generate.products(ids, "p_partkey")


@query(
    f"""SELECT s_suppkey AS store_id,
       {_pick_sql("s_suppkey", 1, generate.STORE_NAMES)} || ' Store' AS store_name,
       {_pick_sql("s_suppkey", 2, generate.CITIES)} AS location,
       {_pick_sql("s_suppkey", 3, generate.FIRST_NAMES)} || ' '
         || {_pick_sql("s_suppkey", 4, generate.LAST_NAMES)} AS manager_name
FROM supplier"""
)
def generated_stores(spark, folder):
    ids = StarViews(spark, folder).table("supplier").select("s_suppkey")
    return generate.stores(ids, "s_suppkey")


@query(
    f"""SELECT o_orderkey AS order_id,
       DATE '2026-01-01' + CAST({_hash_sql("o_orderkey", 1, 365)} AS INTEGER) AS order_date,
       {_hash_sql("o_orderkey", 2, "(SELECT COUNT(*) FROM customer)")} AS customer_id,
       {_hash_sql("o_orderkey", 3, "(SELECT COUNT(*) FROM part)")} AS product_id,
       {_hash_sql("o_orderkey", 4, "(SELECT COUNT(*) FROM supplier)")} AS store_id,
       {_hash_sql("o_orderkey", 5, 5)} + 1 AS quantity,
       round(({_hash_sql("o_orderkey", 6, 49001)} + 1000) / CAST(100.0 AS DOUBLE)
             * ({_hash_sql("o_orderkey", 5, 5)} + 1), 2) AS total_amount
FROM orders"""
)
def generated_sales(spark, folder):
    views = StarViews(spark, folder)
    sizes = [
        views.table(name).agg(F.count(F.lit(1))).scalar()
        for name in ("customer", "part", "supplier")
    ]
    return generate.sales(views.table("orders").select("o_orderkey"), *sizes, id_column="o_orderkey")
