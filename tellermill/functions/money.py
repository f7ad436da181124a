"""Exact money arithmetic and rounding that does not depend on row order.

Sums of doubles change with the order in which partitions are merged. Money is
therefore summed as whole hundredths in a decimal wide enough for any table,
and divided once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: Column) -> Column:
    """Amount in whole hundredths; null for what 18 digits do not hold, NaN and infinity."""
    return F.rint(c * 100).try_cast("decimal(18,0)").cast("bigint")


def sum_cents(c: Column) -> Column:
    """Exact sum of hundredths as a double."""
    return F.sum(cents(c).cast("decimal(18,0)")).cast("double")


def money_sum(c: Column) -> Column:
    return sum_cents(c) / 100


def money_mean(c: Column) -> Column:
    """Mean with one division; null when no row has a value."""
    return F.try_divide(money_sum(c), F.count(c))


def money_mean_2(c: Column) -> Column:
    """Mean rounded to two decimals, half away from zero."""
    return round_half_up(F.try_divide(sum_cents(c), F.count(c)), 0) / 100


def round_half_up(c: Column, digits: int) -> Column:
    """Round half away from zero in plain double arithmetic."""
    scale = 10**digits
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale + F.lit(0.0)


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """Share in percent; null when the whole is zero."""
    share = F.try_divide(part.cast("double") * 100, whole)
    return share if digits is None else round_half_up(share, digits)


def ratio(top: Column, bottom: Column, digits: int = 4) -> Column:
    """Rounded quotient; null when the divisor is zero."""
    return round_half_up(F.try_divide(top.cast("double"), bottom), digits)


def money_text(c: Column) -> Column:
    """Plain text with two decimals, never scientific notation."""
    return c.cast("decimal(28,2)").cast("string")
