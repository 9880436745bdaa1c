"""Date and clock-code parts.

A ticket's violation time is a text code ``hhmm`` followed by ``A`` or
``P`` (e.g. ``0143A``). The parts are cut by position, so malformed codes
stay visible as odd hours or periods instead of turning into NULL.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.numeric import ColumnOrName, col_of

# The valid periods and the valid two-digit hours of the code.
VALID_PERIODS = ("AM", "PM")
VALID_HOURS = ("00", "01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11", "12")


def clock_hour(code: ColumnOrName) -> Column:
    return F.substring(col_of(code), 1, 2)


def clock_minute(code: ColumnOrName) -> Column:
    return F.substring(col_of(code), 3, 2)


def clock_period(code: ColumnOrName) -> Column:
    """Fifth character plus ``M``: ``A`` -> ``AM``; NULL code -> NULL."""
    return F.concat(F.substring(col_of(code), 5, 1), F.lit("M"))


def clock_code(ts: ColumnOrName) -> Column:
    """The ``hhmmA`` code of a timestamp (12-hour clock)."""
    t = col_of(ts)
    return F.concat(F.date_format(t, "hhmm"), F.substring(F.date_format(t, "a"), 1, 1))


def valid_clock(hour: ColumnOrName, period: ColumnOrName) -> Column:
    return col_of(period).isin(*VALID_PERIODS) & col_of(hour).isin(*VALID_HOURS)


def month_range(ts: ColumnOrName, year: int, months: list[int] | tuple[int, ...]) -> Column:
    """``year(ts) = year and month(ts) in months`` written so it pushes down:
    one half-open timestamp range per run of months, OR-ed."""
    t = col_of(ts)
    wanted = sorted(set(months))
    runs: list[list[int]] = []
    for m in wanted:
        if not 1 <= m <= 12:
            raise ValueError(f"no such month: {m}")
        if runs and m == runs[-1][1] + 1:
            runs[-1][1] = m
        else:
            runs.append([m, m])
    if not runs:
        return F.lit(False)
    ranges = []
    for first, last in runs:
        lo = f"{year:04d}-{first:02d}-01 00:00:00"
        end_year, end_month = (year + 1, 1) if last == 12 else (year, last + 1)
        # String bounds are cast to the column's own timestamp type.
        ranges.append((t >= F.lit(lo)) & (t < F.lit(f"{end_year:04d}-{end_month:02d}-01 00:00:00")))
    return reduce(lambda a, b: a | b, ranges)


def on_dates(ts: ColumnOrName, dates: list[str] | tuple[str, ...]) -> Column:
    """``to_date(ts) IN (dates)`` written so it pushes down: one half-open
    day range per date, OR-ed (string bounds take the column's type)."""
    t = col_of(ts)
    ranges = []
    for d in dates:
        day = _dt.date.fromisoformat(d)
        nxt = day + _dt.timedelta(days=1)
        ranges.append((t >= F.lit(f"{day.isoformat()} 00:00:00")) & (t < F.lit(f"{nxt.isoformat()} 00:00:00")))
    return reduce(lambda a, b: a | b, ranges)


def instant(ts: ColumnOrName, zone: str) -> Column:
    """The UTC wall clock of a wall-clock time (TIMESTAMP_NTZ) of ``zone``.

    A time that occurs twice, when clocks go back, is the first of the two; one
    that does not occur, when they go forward, is moved on by what is skipped."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col_of(ts))


def elapsed_seconds(start: ColumnOrName, end: ColumnOrName, zone: str = "UTC") -> Column:
    """Whole seconds that pass between two wall-clock times of ``zone``; the
    session's zone has no part in it."""

    def epoch(ts: ColumnOrName) -> Column:
        moment = col_of(ts) if zone == "UTC" else instant(ts, zone)
        return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment) / 1_000_000)

    return epoch(end) - epoch(start)
