"""Scalar column expressions (all built-in Catalyst functions, no UDFs)."""

from walletyield.functions.exprs import (  # noqa: F401
    annual_to_daily_rate,
    before_day_start,
    bonus_amount,
    day_start,
    exact_daily_rate,
    first_hold_day,
    hold_satisfied,
    iso_seconds,
    parse_cdc_ts,
    pct_vs_avg,
    trunc_second,
    valid_annual_rate,
)
