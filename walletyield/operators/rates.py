"""Daily interest rates: conversion, validation, range, as-of lookup, upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.config import DEFAULT, Thresholds
from walletyield.functions import annual_to_daily_rate as _daily_expr
from walletyield.functions import valid_annual_rate
from walletyield.operators.common import with_scalars


def annual_to_daily_rate(annual: DataFrame, rate_col: str = "annual_rate") -> DataFrame:
    """``(rate_date, annual_rate)`` -> ``(rate_date, daily_rate DECIMAL(18,8))``."""
    return annual.select("rate_date", _daily_expr(F.col(rate_col)).alias("daily_rate"))


def reject_bad_rates(annual: DataFrame, rate_col: str = "annual_rate") -> tuple[DataFrame, DataFrame]:
    """Split into rows whose rate is a finite decimal > -100 and the rest."""
    ok = valid_annual_rate(rate_col)
    good = annual.where(ok).withColumn(rate_col, F.col(rate_col).cast("string").try_cast("double"))
    bad = annual.where(~ok | ok.isNull()).withColumn("reason", F.lit("not a decimal rate above -100"))
    return good, bad


def clamp_rate_range(bounds: DataFrame, as_of: dt.date) -> DataFrame:
    """Rates needed: ``[min_date - 7, min(max_date + 1, as_of)]`` as one row."""
    return bounds.select(
        F.date_sub("min_date", 7).alias("start_date"),
        F.least(F.date_add("max_date", 1), F.lit(as_of).cast("date")).alias("end_date"))


def rate_asof(days: DataFrame, rates: DataFrame, cfg: Thresholds = DEFAULT,
              day_col: str = "payout_date") -> DataFrame:
    """Newest rate dated in ``[day - (lookback-1), day]`` for each day.

    Written as an equi-join: every rate is fanned out to the ``lookback``
    days it may serve, joined to the calendar on the day, and the newest
    source wins (``max_by``). Both sides are one row per date, so their size
    is bounded by the calendar span, not by the ledger.
    Returns ``(day, daily_rate, rate_source_date)``; days without a rate are
    absent.
    """
    span = cfg.lookback_days - 1
    fanned = rates.select(
        F.explode(F.sequence(F.col("rate_date"), F.date_add("rate_date", span))).alias(day_col),
        F.struct(F.col("rate_date"), F.col("daily_rate")).alias("_r"))
    cal = days.select(F.col(day_col)).distinct()
    best = (cal.join(fanned, day_col)
            .groupBy(day_col)
            .agg(F.max_by(F.col("_r"), F.col("_r.rate_date")).alias("_r")))
    return best.select(day_col, F.col("_r.daily_rate").alias("daily_rate"),
                       F.col("_r.rate_date").alias("rate_source_date"))


def missing_rate_days(days: DataFrame, rates: DataFrame, day_col: str = "rate_date") -> DataFrame:
    """Calendar days with no published rate."""
    cal = days.select(F.col(day_col))
    return cal.join(rates.select("rate_date").withColumnRenamed("rate_date", day_col), day_col, "left_anti")


def upsert_rates(current: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Insert-or-update by ``rate_date``; of several incoming rows for a date the last wins.

    ``order`` names the column that says which row is later; without it the row
    order of ``incoming`` counts.
    """
    last = F.col(order) if order else F.monotonically_increasing_id()
    value = F.struct(*[c for c in incoming.columns if c not in ("rate_date", order)])
    inc = (incoming.withColumn("_last", last).withColumn("_value", value)
           .groupBy("rate_date").agg(F.max_by("_value", "_last").alias("_value")).select("rate_date", "_value.*"))
    return current.join(inc.select("rate_date"), "rate_date", "left_anti").unionByName(inc.select(*current.columns))


def load_rates(raw: DataFrame, bounds: DataFrame, current: DataFrame, as_of: dt.date,
               rate_col: str = "annual_rate") -> tuple[DataFrame, DataFrame]:
    """Range -> reject -> convert -> upsert. Returns ``(rates_table, rejected)``.

    A column ``file_order`` of ``raw`` (see ``read_rate_series``) says which of two
    rates for a date is the later one.
    """
    rng = clamp_rate_range(bounds, as_of)
    in_range = with_scalars(raw, rng) \
        .where(F.col("rate_date").between(F.col("start_date"), F.col("end_date"))) \
        .drop("start_date", "end_date")
    good, bad = reject_bad_rates(in_range, rate_col)
    order = "file_order" if "file_order" in good.columns else None
    daily = good.select("rate_date", _daily_expr(F.col(rate_col)).alias("daily_rate"), *([order] if order else []))
    return upsert_rates(current, daily, order), bad
