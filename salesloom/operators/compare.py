"""Compare the present content of a table with an earlier one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.plans.session import work_dir


def now_vs_then(current: DataFrame, old: DataFrame) -> DataFrame:
    """One row with both row counts, each read as a scalar subquery."""
    spark = current.sparkSession
    return spark.range(1).select(
        current.agg(F.count(F.lit(1))).scalar().alias("current_orders"),
        old.agg(F.count(F.lit(1))).scalar().alias("old_orders"),
    )


def presence(current: DataFrame, old: DataFrame, order_id: int) -> DataFrame:
    """Rows of one order, now and then."""
    match = F.col("order_id") == order_id
    return now_vs_then(current.where(match), old.where(match))


def row_changes(current: DataFrame, old: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, over the columns both sides have.

    `copies` is positive for rows that were added and negative for rows that are
    gone. Equal rows fold into one row per map task before the shuffle, and a row
    that was added a billion times is still one row of the result.
    """
    common = [c for c in current.columns if c in old.columns]
    signed = current.select(*common, F.lit(1).cast("bigint").alias("copies")).unionByName(
        old.select(*common, F.lit(-1).cast("bigint").alias("copies"))
    )
    return signed.groupBy(*common).agg(F.sum("copies").alias("copies")).where("copies <> 0")


#: A row's 64-bit hash is added up in three pieces, so that 2**41 rows don't leave BIGINT.
PIECE_BITS = 22


def row_hash(columns: list[str]) -> Column:
    """A 64-bit hash of the values, which also tells apart where a NULL stands."""
    nulls = [
        reduce(Column.bitwiseOR, [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in part])
        for part in (list(enumerate(columns[first : first + 62])) for first in range(0, len(columns), 62))
    ]
    return F.xxhash64(*columns, *nulls)


def fingerprints(df: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    """Per value of `by`: row_count and sums of the rows' hashes, which don't depend on their order.

    Partitions with equal fingerprints hold the same rows, copies counted, but for a chance of about
    2**-64. Sums are taken before anything is shuffled: one row per value and task.
    """
    hashed = df.select(F.col(by), row_hash(columns or df.columns).alias("h"))
    piece = lambda k: F.shiftrightunsigned("h", k * PIECE_BITS).bitwiseAND((1 << PIECE_BITS) - 1)
    return hashed.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(piece(k)).alias(f"hash_{k}") for k in range(3)]
    )


def differing(current: DataFrame, old: DataFrame, by: str) -> DataFrame:
    """Values of `by`, NULL included, whose rows differ between two tables of equal columns."""
    mine, its = fingerprints(current, by), fingerprints(old, by, current.columns)
    said = [c for c in mine.columns if c != by]
    side = lambda df, name: df.select(F.col(by).alias(f"{name}_by"), F.struct(*said).alias(name))
    both = side(mine, "a").join(side(its, "b"), F.col("a_by").eqNullSafe(F.col("b_by")), "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(F.coalesce("a_by", "b_by").alias(by))


def row_changes_within(current: DataFrame, old: DataFrame, by: str) -> DataFrame:
    """`row_changes`, where only partitions with different fingerprints are shuffled.

    Both tables are read for the fingerprints, which go to a written table of one row per partition.
    Where `by` is a partition column of the files, Spark then opens only the folders that differ.
    """
    spark = current.sparkSession
    common = [c for c in current.columns if c in old.columns]
    current, old = current.select(*common), old.select(*common)
    # Spark prunes by a side only if that is filtered by a comparison.
    found = differing(current, old, by).withColumn("changed", F.lit(1))
    found.write.parquet(folder := work_dir(spark, "differing"))
    found = spark.read.schema(found.schema).parquet(folder)
    no_value = not found.where(F.col(by).isNull()).isEmpty()

    def kept(df: DataFrame) -> DataFrame:
        rows = df.join(found.where("changed = 1").select(by), by, "left_semi")
        rows = rows.unionByName(df.where(F.col(by).isNull())) if no_value else rows
        return rows.select(*common)

    return row_changes(kept(current), kept(old))
