"""Range filters that reach partition directories, and reports on what they skip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.calendar import DateLike

# Partition granularities, as the unit that `trunc` takes.
TRUNC_UNIT = {"day": "DD", "month": "MM"}


MICROS_A_DAY = 86_400_000_000


def utc_date(value: Column, kind: str) -> Column:
    """The date of a value; of a timestamp with a zone its date in UTC, whatever the session's zone."""
    if kind != "timestamp":
        return value.cast("date")
    days = F.floor(F.unix_micros(value) / F.lit(MICROS_A_DAY).cast("decimal(20,0)"))
    return F.date_from_unix_date(days.cast("int"))


def partition_value(column: str, granularity: str, kind: str = "date") -> Column:
    """The date that a row's partition directory is named after; kind is the column's type."""
    if granularity not in ("day", *TRUNC_UNIT):
        raise ValueError(f"granularity must be day or month, got {granularity!r}")
    day = utc_date(F.col(column), kind)
    return F.trunc(day, TRUNC_UNIT["month"]) if granularity == "month" else day


def where_range(
    df: DataFrame,
    column: str,
    low: DateLike | None,
    high: DateLike | None,
    partition_column: str | None = None,
    granularity: str = "day",
) -> DataFrame:
    """Rows with low <= column < high; None leaves that end open, and keeps no NULL either.

    With a derived partition column the same range is put on it too: a filter on
    a timestamp says nothing about the directory named after its day, so without
    the second predicate every file would be opened.
    """
    kind = df.schema[column].dataType.simpleString()
    value, part = F.col(column), None if partition_column in (None, column) else F.col(partition_column)
    out = df if low is not None or high is not None else df.where(value.isNotNull())
    if low is not None:
        low = (low if isinstance(low, Column) else F.lit(low)).cast(kind)
        out = out.where(value >= low)
        if part is not None:
            first = utc_date(low, kind)
            out = out.where(part >= (F.trunc(first, TRUNC_UNIT["month"]) if granularity == "month" else first))
    if high is not None:
        high = (high if isinstance(high, Column) else F.lit(high)).cast(kind)
        out = out.where(value < high)
        if part is not None:
            # The last day that holds a value below the exclusive upper bound.
            last = F.date_sub(high, 1) if kind == "date" else utc_date(high - F.expr("INTERVAL 1 MICROSECOND"), kind)
            out = out.where(part <= last)
    return out


def files_report(df: DataFrame, partition_column: str | None = None) -> DataFrame:
    """Path, partition and number of rows of each file behind a file-based DataFrame."""
    columns = [F.col("_metadata.file_path").alias("file_path")]
    if partition_column is not None:
        columns.append(F.col(partition_column).alias("partition"))
    located = df.select(*columns)
    return located.groupBy(*located.columns).agg(F.count(F.lit(1)).alias("record_count"))


def files_per_partition(files: DataFrame) -> DataFrame:
    return files.groupBy("partition").agg(F.count(F.lit(1)).alias("files")).orderBy("partition")
