"""Scalar column helpers (all built-in Spark expressions, no UDFs)."""

from tallyframe.functions.bins import (
    BAND_OTHER,
    PAYMENT_TYPE_DEFAULT,
    PAYMENT_TYPE_LABELS,
    SEASONS,
    TIME_OF_DAY_BINS,
    TIP_BANDS_AS_WRITTEN,
    TIP_BANDS_HALF_OPEN,
    band,
    decode,
    season,
    time_of_day,
)
from tallyframe.functions.clock import (
    VALID_HOURS,
    VALID_PERIODS,
    clock_code,
    clock_hour,
    clock_minute,
    clock_period,
    elapsed_seconds,
    instant,
    month_range,
    on_dates,
    valid_clock,
)
from tallyframe.functions.numeric import (
    col_of,
    duration_seconds,
    pct,
    pct_change,
    rate_per_hour,
    round_half_up,
)

__all__ = [
    "BAND_OTHER",
    "PAYMENT_TYPE_DEFAULT",
    "PAYMENT_TYPE_LABELS",
    "SEASONS",
    "TIME_OF_DAY_BINS",
    "TIP_BANDS_AS_WRITTEN",
    "TIP_BANDS_HALF_OPEN",
    "VALID_HOURS",
    "VALID_PERIODS",
    "band",
    "clock_code",
    "clock_hour",
    "clock_minute",
    "clock_period",
    "col_of",
    "decode",
    "duration_seconds",
    "elapsed_seconds",
    "instant",
    "month_range",
    "on_dates",
    "pct",
    "pct_change",
    "rate_per_hour",
    "round_half_up",
    "season",
    "time_of_day",
    "valid_clock",
]
