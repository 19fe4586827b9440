"""Change propagation: which days paid before a run no longer hold, and what they pay now.

A movement at time t changes the start-of-day balances of its user from the day after t on.
So of every user of a run's files the days from ``since``, the day after the earliest new
movement, may differ. For these users (and only they) the payouts of the days paid before
are derived again from the validity intervals of the new ledger and set against the stored
rows; a day counts as changed where a row differs. A day whose rate in force has changed, or
that has become payable, is derived again for all users.

Only changed days are written: the rows of users that did not change, and rows that pay what
they paid, keep their ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.config import Thresholds
from walletyield.functions import bonus_amount
from walletyield.plans.payouts import calendar, eligible_days, one_row_period, payouts_period
from walletyield.plans.store import read_intervals, read_payout_days, read_payouts


def day_frame(spark: SparkSession, days: list[dt.date]) -> DataFrame:
    """The days between the first and the last of a list, as ``payout_date``."""
    return calendar(one_row_period(spark, min(days), max(days)))


def changed_users(cdc: DataFrame, last_day: dt.date) -> DataFrame:
    """``(user_id, since)``: the first day, up to ``last_day``, on which a user of the new
    movements may start with another balance or another last movement."""
    return (cdc.groupBy("user_id").agg(F.date_add(F.to_date(F.min("ts")), 1).alias("since"))
            .where(F.col("since") <= F.lit(last_day)))


def payouts_of(intervals: DataFrame, changed: DataFrame, rate_of: dict, cfg: Thresholds) -> DataFrame:
    """Payouts of changed users on the days of ``rate_of`` (one rate for each), from ``since`` on."""
    spark = intervals.sparkSession
    period = one_row_period(spark, min(rate_of), max(rate_of))
    days = spark.createDataFrame(list(rate_of.items()), "payout_date date, daily_rate decimal(18,8)")
    own = intervals.join(changed.select("user_id"), "user_id", "left_semi")
    return (eligible_days(own, period, cfg).join(F.broadcast(days), "payout_date").join(changed, "user_id")
            .where(F.col("payout_date") >= F.col("since"))
            .select("payout_date", "user_id", bonus_amount("balance_at_start_of_day", "daily_rate").alias("calculated_amount")))


def compare(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """payout_date, user_id, the amount now (null: no longer paid), the id of an unchanged
    row, and whether the row differs."""
    was = stored.select("payout_date", "user_id", F.col("calculated_amount").alias("_was"), F.col("payout_id").alias("_id"))
    same = F.col("_was").eqNullSafe(F.col("calculated_amount"))
    return (fresh.join(was, ["payout_date", "user_id"], "full_outer")
            .select("payout_date", "user_id", "calculated_amount", F.when(same, F.col("_id")).alias("payout_id"), (~same).alias("differs")))


def corrected_days(run, cdc: DataFrame, rates: DataFrame, others: list[dt.date], rate_of: dict) -> tuple[DataFrame | None, dict]:
    """Rows of the days among ``others`` (paid by earlier runs) that are to be paid again,
    and these days with their rates. ``rate_of`` holds the days that can be paid now."""
    spark, cfg, base, old = run.spark, run.cfg.thresholds, run.base, run.old
    now = {d: rate_of[d] for d in others if d in rate_of}
    if not now:
        return None, {}
    before = {r.payout_date: r.daily_rate for r in read_payout_days(spark, base, old)
              .select("payout_date", "daily_rate").distinct().collect()}
    whole = {d: r for d, r in now.items() if before.get(d) != r}
    rows = None
    if whole:
        rows = (payouts_period(read_intervals(spark, base, run.facts), rates, one_row_period(spark, min(whole), max(whole)), cfg)
                .where(F.col("payout_date").isin(list(whole))).withColumn("payout_id", F.lit(None).cast("long")))
    rest = {d: r for d, r in now.items() if d not in whole}
    again = dict(whole)
    if rest:
        changed = run.stage(changed_users(cdc, max(rest)), "changed")
        first = changed.agg(F.min("since")).first()[0]
        rest = {d: r for d, r in rest.items() if first is not None and d >= first}
    if rest:
        since = min(rest)
        stored = read_payouts(spark, base, old, since, ids=True).where(F.col("payout_date").isin(list(rest)))
        own = stored.join(changed, "user_id").where(F.col("payout_date") >= F.col("since")).drop("since")
        open_ = F.col("nxt").isNull() | (F.col("nxt") >= F.lit(dt.datetime.combine(since, dt.time())).cast("timestamp_ntz"))
        fresh = payouts_of(read_intervals(spark, base, run.facts).where(open_), changed, rest, cfg)
        compared = run.stage(compare(own, fresh), "compared")
        dirty = {r[0]: rest[r[0]] for r in compared.where("differs").select("payout_date").distinct().collect()}
        if dirty:
            on_dirty = F.col("payout_date").isin(list(dirty))
            kept = (stored.where(on_dirty).join(changed, "user_id", "left")
                    .where(F.col("since").isNull() | (F.col("payout_date") < F.col("since"))).drop("since"))
            mended = compared.where(on_dirty & F.col("calculated_amount").isNotNull())
            cols = ["payout_date", "user_id", "calculated_amount", "payout_id"]
            part = kept.select(*cols).unionByName(mended.select(*cols))
            rows = part if rows is None else rows.select(*cols).unionByName(part)
            again |= dirty
    return rows, again
