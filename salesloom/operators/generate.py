"""Repeatable synthetic rows for the star schema.

Each value is a function of the row's id, so any partition of the ids can be
generated on its own, retries give the same rows and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.calendar import DateLike, as_date, date_parts, each_day
from salesloom.functions.money import round_money
from salesloom.functions.text import capitalised, joined_words

# Word lists of the generated dimensions.
FIRST_NAMES = ["Ada", "Bruno", "Chloe", "Dario", "Elif", "Farah", "Gustav", "Hana", "Ivan", "Jaya",
               "Kofi", "Lena", "Mateo", "Nadia", "Omar", "Pilar"]
LAST_NAMES = ["Abbott", "Becker", "Costa", "Duran", "Eriksen", "Ferrari", "Gupta", "Haddad",
              "Ivanova", "Jensen", "Kimura", "Lopez", "Mbeki", "Novak", "Okafor", "Petrov"]
PRODUCT_WORDS = ["amber", "brisk", "copper", "dusty", "early", "frosted", "gentle", "hollow"]
PRODUCT_NOUNS = ["Basket", "Candle", "Drill", "Kettle", "Lamp", "Notebook", "Scarf", "Teapot"]
CATEGORIES = ["Garden", "Kitchen", "Office", "Outdoor", "Toys"]
STORE_NAMES = ["Corner", "Harbour", "Market", "Mill", "Park", "Station"]
CITIES = ["Aarhus", "Bologna", "Cardiff", "Dakar", "Essen", "Fukuoka", "Graz", "Hobart"]

# The default size of a generated data set.
N_CUSTOMERS, N_PRODUCTS, N_STORES, N_SALES = 100, 20, 5, 1000
START, N_DAYS = "2026-01-01", 365

# Ranges of the generated attributes (prices in cents).
MAX_UNITS = 5
MIN_PRICE, MAX_PRICE = 1000, 50000
SIGNUP_DAYS = 730

#: Hexadecimal digits of the hash that count: 60 bits.
HASH_DIGITS = 15


def hashed(row_id: Column, salt: int, bound: int | Column) -> Column:
    """A value in [0, bound) that depends on the id and the salt only.

    60 bits of an MD5 of both: every value below a bound of up to 2**60 can occur, and
    values repeat for no other id in any regular way.
    """
    digest = F.md5(F.concat(row_id.cast("bigint").cast("string"), F.lit(f":{salt}")).cast("binary"))
    mixed = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")
    bound = bound if isinstance(bound, Column) else F.lit(bound)
    return mixed % bound.cast("bigint")


def pick(row_id: Column, salt: int, words: list[str]) -> Column:
    index = hashed(row_id, salt, len(words)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(w) for w in words]), index)


def price(row_id: Column, salt: int) -> Column:
    return (hashed(row_id, salt, MAX_PRICE - MIN_PRICE + 1) + MIN_PRICE) / 100.0


def new_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def dates(source: DataFrame, first: Column, last: Column) -> DataFrame:
    """The date dimension from first to last; both may be aggregates of the source."""
    days = source.select(first.alias("first"), last.alias("last")).select(
        each_day(F.col("first"), F.col("last")).alias("date_key")
    )
    return days.select("date_key", *date_parts(F.col("date_key")))


def dates_of_year(
    spark: SparkSession, start: DateLike = START, n_days: int = N_DAYS
) -> DataFrame:
    first = as_date(start)
    return dates(spark.range(1), first, F.date_add(first, n_days - 1))


def customers(ids: DataFrame, anchor: DateLike, id_column: str = "id") -> DataFrame:
    """Customers who signed up within the two years before the anchor date."""
    row_id = F.col(id_column)
    first, last = pick(row_id, 1, FIRST_NAMES), pick(row_id, 2, LAST_NAMES)
    return ids.select(
        row_id.alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(
            F.lower(F.concat_ws(".", first, last)), row_id.cast("string"), F.lit("@example.com")
        ).alias("email"),
        F.date_sub(as_date(anchor), hashed(row_id, 3, SIGNUP_DAYS + 1).cast("int")).alias(
            "signup_date"
        ),
    )


def products(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Products priced from 10.00 to 500.00."""
    row_id = F.col(id_column)
    return ids.select(
        row_id.alias("product_id"),
        joined_words(
            capitalised(pick(row_id, 1, PRODUCT_WORDS)), pick(row_id, 2, PRODUCT_NOUNS)
        ).alias("product_name"),
        pick(row_id, 3, CATEGORIES).alias("category"),
        round_money(price(row_id, 4)).alias("price"),
    )


def stores(ids: DataFrame, id_column: str = "id") -> DataFrame:
    row_id = F.col(id_column)
    return ids.select(
        row_id.alias("store_id"),
        joined_words(pick(row_id, 1, STORE_NAMES), F.lit("Store")).alias("store_name"),
        pick(row_id, 2, CITIES).alias("location"),
        joined_words(pick(row_id, 3, FIRST_NAMES), pick(row_id, 4, LAST_NAMES)).alias(
            "manager_name"
        ),
    )


def sales(
    ids: DataFrame,
    n_customers: int | Column,
    n_products: int | Column,
    n_stores: int | Column,
    start: DateLike = START,
    n_days: int = N_DAYS,
    id_column: str = "id",
) -> DataFrame:
    """One sale per id: 1 to 5 units at 10.00 to 500.00 each, keys within the dimensions.

    The unit price is drawn per sale and does not look at the product's price.
    """
    row_id = F.col(id_column)
    units = hashed(row_id, 5, MAX_UNITS) + 1
    return ids.select(
        row_id.alias("order_id"),
        F.date_add(as_date(start), hashed(row_id, 1, n_days).cast("int")).alias("order_date"),
        hashed(row_id, 2, n_customers).alias("customer_id"),
        hashed(row_id, 3, n_products).alias("product_id"),
        hashed(row_id, 4, n_stores).alias("store_id"),
        units.alias("quantity"),
        round_money(price(row_id, 6) * units).alias("total_amount"),
    )


def star_schema(
    spark: SparkSession,
    n_customers: int = N_CUSTOMERS,
    n_products: int = N_PRODUCTS,
    n_stores: int = N_STORES,
    n_sales: int = N_SALES,
    start: DateLike = START,
    n_days: int = N_DAYS,
) -> dict[str, DataFrame]:
    """All five tables, with every key of the fact in its dimension."""
    return {
        "dim_customer": customers(new_ids(spark, n_customers), start),
        "dim_product": products(new_ids(spark, n_products)),
        "dim_store": stores(new_ids(spark, n_stores)),
        "dim_date": dates_of_year(spark, start, n_days),
        "fact_sales": sales(
            new_ids(spark, n_sales), n_customers, n_products, n_stores, start, n_days
        ),
    }
