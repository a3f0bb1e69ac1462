"""Calendar parts, date sequences and periods relative to an anchor date.

The anchor is always an argument: results never depend on the wall clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date | Column


def as_date(value: DateLike) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def date_parts(date: Column) -> list[Column]:
    """day, month, year and the English weekday name of a date."""
    return [
        F.day(date).alias("day"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        F.date_format(date, "EEEE").alias("day_of_week"),
    ]


def each_day(first: Column, last: Column) -> Column:
    """One row per day from first to last, both included."""
    return F.explode(F.sequence(first, last))


def previous_month(anchor: DateLike) -> tuple[Column, Column]:
    """[first day of the month before the anchor's month, first day of the anchor's month)."""
    month_start = F.trunc(as_date(anchor), "MM")
    return F.add_months(month_start, -1), month_start


def previous_weekend(anchor: DateLike) -> tuple[Column, Column]:
    """[Saturday, Monday) of the last weekend that ended before the anchor."""
    sunday = F.next_day(F.date_sub(as_date(anchor), 8), "Sun")
    return F.date_sub(sunday, 1), F.date_add(sunday, 1)
