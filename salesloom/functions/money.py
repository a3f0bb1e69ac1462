"""Exact sums of money held in DOUBLE columns.

A sum of doubles depends on the order of the rows, which no cluster keeps. Amounts
have two decimals, so they are added up as whole cents in BIGINT: exact, and several
times faster than DECIMAL. An amount with more decimals is an error: rounding it would
change the sum without a word. Round such amounts first, or name their decimals. More than 9.2e16 units of currency in one sum would leave
BIGINT; Spark then raises an error, it does not wrap around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Finer than money, for rates such as discounts.
RATE_DECIMALS = 4
# How far a DOUBLE may lie from a whole number of units.
SLACK = 1e-6


def is_nonfinite(value: Column) -> Column:
    """True for NaN and both infinities, NULL for NULL."""
    return F.isnan(value - value)


def whole_units(value: Column, decimals: int) -> Column:
    """The value in units of its last decimal, as BIGINT; NULL for NaN and infinities.

    A value that isn't whole in these units, but for the rounding of DOUBLE, raises.
    """
    scaled = value * F.lit(float(10**decimals))
    whole = F.rint(scaled)
    off = F.abs(scaled - whole) > F.greatest(F.lit(SLACK), F.abs(scaled) * F.lit(2.0**-50))
    problem = F.concat(value.cast("string"), F.lit(f" has more than {decimals} decimals"))
    units = F.when(off, F.raise_error(problem).cast("double")).otherwise(whole)
    return F.when(~is_nonfinite(value), units).cast("bigint")


def cents(value: Column, decimals: int = 2) -> Column:
    """The value in units of its last decimal, cents by default."""
    return whole_units(value, decimals)


def from_cents(total: Column, decimals: int = 2) -> Column:
    """Back to DOUBLE through DECIMAL, so that large totals are rounded once only."""
    return (total.cast("decimal(20,0)") / F.lit(10**decimals)).cast("double")


def exact_avg(value: Column, decimals: int = RATE_DECIMALS) -> Column:
    """Average of a DOUBLE column through an exact sum; NULL when there is no value."""
    total = F.sum(whole_units(value, decimals)).cast("decimal(20,0)") / F.lit(10**decimals)
    return F.try_divide(total.cast("double"), F.count(value))


def round_money(value: Column) -> Column:
    return F.round(value, 2)
