"""Column expressions shared by the operators.

All of them stay inside whole-stage codegen: only built-in functions.
Timestamps are ``timestamp_ntz`` throughout; functions that return a
session-zone ``timestamp`` (``date_trunc``, ``try_to_timestamp``) are cast
back, and the session zone is pinned to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from walletyield.config import MONEY, RATE, RATE_10DP

# fixed value: CDC text timestamp pattern (seconds; a trailing fraction is ignored)
CDC_TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_second(ts) -> Column:
    return F.date_trunc("second", _c(ts)).cast("timestamp_ntz")


def parse_cdc_ts(c) -> Column:
    """Parse ``yyyy-MM-dd'T'HH:mm:ss`` text; a fraction is dropped, junk becomes NULL."""
    return trunc_second(F.try_to_timestamp(_c(c), F.lit(CDC_TS_PATTERN)))


def iso_seconds(ts) -> Column:
    """Timestamp -> ISO text at second precision."""
    return F.date_format(_c(ts), ISO_SECONDS)


def day_start(d) -> Column:
    """Midnight that opens day ``d`` as timestamp_ntz."""
    return _c(d).cast("timestamp_ntz")


def before_day_start(ts, d) -> Column:
    """Strictly before 00:00:00 of day ``d``."""
    return _c(ts) < day_start(d)


def hold_satisfied(ts, d, hold_hours: int = 24) -> Column:
    """Whole-second last move at or before ``day_start(d) - hold``."""
    return trunc_second(ts) <= day_start(d) - F.make_dt_interval(F.lit(0), F.lit(hold_hours))


def first_hold_day(ts, hold_hours: int = 24) -> Column:
    """First day whose midnight is >= trunc_second(ts) + hold (the hold rule as a date)."""
    t = trunc_second(ts) + F.make_dt_interval(F.lit(0), F.lit(hold_hours))
    t = t.cast("timestamp_ntz")
    return F.when(t == F.to_date(t).cast("timestamp_ntz"), F.to_date(t)).otherwise(
        F.date_add(F.to_date(t), 1))


def bonus_amount(balance, rate) -> Column:
    """Exact decimal product, HALF_UP to 2 decimals."""
    return (_c(balance).cast(MONEY) * _c(rate).cast(RATE)).cast(MONEY)


def valid_annual_rate(c) -> Column:
    """Text or number that is a finite decimal above -100 (NaN and junk rejected)."""
    d = _c(c).cast("string").try_cast("decimal(18,8)")
    return d.isNotNull() & (d > F.lit(-100))


def exact_daily_rate(annual) -> Column:
    """(1 + a/100) ** (1/365) - 1, HALF_UP to 10 dp."""
    a = _c(annual).cast("double")
    raw = F.pow(F.lit(1.0) + a / F.lit(100.0), F.lit(1.0) / F.lit(365.0)) - F.lit(1.0)
    return F.round(raw, 10).cast(RATE_10DP)


def annual_to_daily_rate(annual) -> Column:
    """The daily rate as it is stored: :func:`exact_daily_rate` at 8 dp."""
    return exact_daily_rate(annual).cast(RATE)


def pct_vs_avg(x, avg) -> Column:
    """100 * (x - avg) / avg; NULL when avg is 0."""
    return F.try_divide(F.lit(100.0) * (_c(x).cast("double") - _c(avg).cast("double")),
                        _c(avg).cast("double"))
