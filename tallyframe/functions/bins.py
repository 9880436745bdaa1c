"""Value bins: code decoding, range bands, time-of-day bins and seasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.numeric import ColumnOrName, col_of

# Payment-type codes of the trip data dictionary. Code 5 and
# any unlisted code both read "Unknown"; they stay separate groups.
PAYMENT_TYPE_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_TYPE_DEFAULT = "Unknown"

# The six 4-hour bins of a day, as (label, period, hours).
# Anything not listed -- including malformed hours -- is "Midnight".
TIME_OF_DAY_BINS = (
    ("Dawn", "AM", ("03", "04", "05", "06")),
    ("Morning", "AM", ("07", "08", "09", "10")),
    ("Afternoon", "AM", ("11",)),
    ("Afternoon", "PM", ("12", "01", "02")),
    ("Evening", "PM", ("03", "04", "05", "06")),
    ("Night", "PM", ("07", "08", "09", "10")),
)
TIME_OF_DAY_OTHER = "Midnight"

# Seasons by month number; any other month is "Fall".
SEASONS = (
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
)
SEASON_OTHER = "Fall"

# The tip bands as the question states them, half-open.
TIP_BANDS_HALF_OPEN = (
    ("[0-5)", 0.0, 5.0, True, False),
    ("[5-10)", 5.0, 10.0, True, False),
    ("[10-15)", 10.0, 15.0, True, False),
    ("[15-20)", 15.0, 20.0, True, False),
    (">=20", 20.0, None, True, None),
)
# The tip bands as the original query wrote them: inclusive
# cent ranges (gaps fall to the other label) and the 10.01-15.00 band
# carrying the 0-5 label.
TIP_BANDS_AS_WRITTEN = (
    ("Tip between $0.00 - $5.00", 0.00, 5.00, True, True),
    ("Tip between $5.01 - $10.00", 5.01, 10.00, True, True),
    ("Tip between $0.00 - $5.00", 10.01, 15.00, True, True),
    ("Tip between $15.01 - $20.00", 15.01, 20.00, True, True),
    ("Tip greater than $20", 20.00, None, False, None),
)
BAND_OTHER = "Other amount"


def decode(code: ColumnOrName, labels: Mapping[object, str], default: str | None = None) -> Column:
    """CASE code WHEN k THEN label ... ELSE default."""
    c = col_of(code)
    expr = None
    for key, label in labels.items():
        expr = F.when(c == F.lit(key), F.lit(label)) if expr is None else expr.when(c == F.lit(key), F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


Band = tuple[str, float | None, float | None, bool | None, bool | None]


def band(value: ColumnOrName, bands: Sequence[Band], other: str | None = BAND_OTHER) -> Column:
    """First matching (label, low, high, low_inclusive, high_inclusive) wins.

    ``None`` for a bound means unbounded on that side. Values matching no
    band (negatives, gaps, NULL) get ``other``.
    """
    v = col_of(value)
    expr = None
    for label, lo, hi, lo_inc, hi_inc in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & ((v >= F.lit(lo)) if lo_inc else (v > F.lit(lo)))
        if hi is not None:
            cond = cond & ((v <= F.lit(hi)) if hi_inc else (v < F.lit(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other))


def time_of_day(hour: ColumnOrName, period: ColumnOrName) -> Column:
    h, p = col_of(hour), col_of(period)
    expr = None
    for label, per, hours in TIME_OF_DAY_BINS:
        cond = h.isin(*hours) & (p == F.lit(per))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(TIME_OF_DAY_OTHER))


def season(month: ColumnOrName) -> Column:
    """Season of a month number; a NULL month stays NULL."""
    m = col_of(month)
    expr = F.when(m.isNull(), F.lit(None).cast("string"))
    for label, months in SEASONS:
        expr = expr.when(m.isin(*months), F.lit(label))
    return expr.otherwise(F.lit(SEASON_OTHER))
