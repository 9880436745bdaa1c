"""Numeric column helpers: rounding, shares, rates, deviations.

All are built-in Spark expressions, so they stay inside whole-stage
codegen; division goes through ``try_divide`` so a zero divisor yields
NULL under ANSI mode instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName, digits: int = 2) -> Column:
    """Round half away from zero on the value's decimal form; result double.

    Spark rounds a double through its shortest decimal text, so 1.005
    becomes 1.01 (as written) instead of following its binary neighbour;
    values of any size are kept.
    """
    return F.round(col_of(c).cast("double"), digits)


def pct(part: ColumnOrName, total: ColumnOrName, digits: int | None = 2) -> Column:
    """``round(part / total * 100, digits)``; NULL when total is 0."""
    share = F.try_divide(col_of(part), col_of(total)) * F.lit(100.0)
    return share if digits is None else round_half_up(share, digits)


def duration_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.unix_timestamp(col_of(end)) - F.unix_timestamp(col_of(start))


def rate_per_hour(
    amount: ColumnOrName, start: ColumnOrName, end: ColumnOrName, digits: int | None = 2
) -> Column:
    """``amount / hours(start -> end)``; NULL for a zero duration."""
    hours = duration_seconds(start, end) / F.lit(3600.0)
    rate = F.try_divide(col_of(amount), hours)
    return rate if digits is None else round_half_up(rate, digits)


def pct_change(value: ColumnOrName, reference: ColumnOrName, digits: int | None = 2) -> Column:
    """Percent above (+) or below (-) ``reference``."""
    change = (F.try_divide(col_of(value), col_of(reference)) - F.lit(1.0)) * F.lit(100.0)
    return change if digits is None else round_half_up(change, digits)
