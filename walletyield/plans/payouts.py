"""Daily bonus payouts: period, calendar, one day, a whole period, audit.

The reference loops over days on the driver and runs 6-95 Spark actions per
day. Here a whole period is one plan: each balance row is valid (and held
long enough) for a contiguous range of days, computed row-locally after one
scan per user, exploded to those days and joined to the as-of rate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.config import DEFAULT, MONEY, Thresholds
from walletyield.functions import bonus_amount, first_hold_day, hold_satisfied
from walletyield.operators.common import with_scalars
from walletyield.operators.scan import keyed_scan
from walletyield.operators.ledger import latest_snapshot, period_bounds
from walletyield.operators.rates import rate_asof


def resolve_period(bounds: DataFrame, as_of: dt.date, start: dt.date | None = None,
                   end: dt.date | None = None) -> DataFrame:
    """One row ``(start_date, end_date)``.

    Both overrides: used as given (start > end raises ``ValueError``). Only
    one: ``ValueError`` (the reference ignored it silently). None: from the
    history, ``[min + 1, min(as_of - 1, max)]``; empty history gives NULLs,
    and every consumer then yields no rows.
    """
    spark = bounds.sparkSession
    if start is not None and end is not None:
        if start > end:
            raise ValueError(f"empty period: {start} comes after {end}")
        return one_row_period(spark, start, end)
    if (start is None) != (end is None):
        raise ValueError("Give both start and end, or neither.")
    return bounds.select(
        F.date_add("min_date", 1).alias("start_date"),
        F.least(F.date_sub(F.lit(as_of).cast("date"), 1), F.col("max_date")).alias("end_date"))


def calendar(period: DataFrame, day_col: str = "payout_date") -> DataFrame:
    """Days ``start..end`` inclusive (empty when start > end or NULL)."""
    p = period.where(F.col("start_date") <= F.col("end_date"))
    return p.select(F.explode(F.sequence("start_date", "end_date")).alias(day_col))


def calendar_range(spark: SparkSession, lo: dt.date, hi: dt.date, day_col: str = "payout_date") -> DataFrame:
    return calendar(one_row_period(spark, lo, hi), day_col)


def one_row_period(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """A literal one-row period, built JVM-side (no Python RDD)."""
    return spark.range(1).select(F.lit(lo).cast("date").alias("start_date"),
                                 F.lit(hi).cast("date").alias("end_date"))


def payouts_day(history: DataFrame, rates: DataFrame, day: dt.date,
                cfg: Thresholds = DEFAULT) -> DataFrame:
    """Payouts of one day: snapshot -> as-of rate -> eligible -> amount."""
    spark = history.sparkSession
    d = F.lit(day).cast("date")
    rate = rate_asof(calendar_range(spark, day, day), rates, cfg)
    snap = latest_snapshot(history, d)
    eligible = snap.where((F.col("balance_at_start_of_day") > F.lit(cfg.min_balance)) &
                          hold_satisfied("last_movement_timestamp", d, cfg.hold_hours))
    # the one-row rate is attached by a broadcast equi-join (the literal of the reference)
    return (eligible.withColumn("payout_date", d)
            .join(F.broadcast(rate), "payout_date")
            .select("payout_date", "user_id",
                    bonus_amount("balance_at_start_of_day", "daily_rate").alias("calculated_amount")))


def eligible_days(history: DataFrame, period: DataFrame, cfg: Thresholds = DEFAULT) -> DataFrame:
    """``(payout_date, user_id, balance_at_start_of_day, last_movement_timestamp)``
    for every day of the period on which the user's start-of-day balance
    passes both rules (before the rate lookup). See :func:`payouts_period`."""
    p = period.select(F.col("start_date").alias("_lo"), F.col("end_date").alias("_hi"))
    first = F.greatest(F.col("_lo"), F.date_add(F.to_date("ts"), 1), first_hold_day("ts", cfg.hold_hours))
    last = F.least(F.col("_hi"), F.coalesce(F.to_date("nxt"), F.col("_hi")))
    # (a NULL time can't be placed: such rows are not a snapshot of any day)
    held = history.where((F.col("balance") > F.lit(cfg.min_balance)) & F.col("ts").isNotNull())
    spans = (with_scalars(held, p)
             .select("user_id", "balance", "ts", first.alias("_f"), last.alias("_t"))
             .where(F.col("_f") <= F.col("_t")))
    return spans.select(F.explode(F.sequence("_f", "_t")).alias("payout_date"), "user_id",
                        F.col("balance").alias("balance_at_start_of_day"),
                        F.col("ts").alias("last_movement_timestamp"))


def payouts_period(history: DataFrame, rates: DataFrame, period: DataFrame,
                   cfg: Thresholds = DEFAULT) -> DataFrame:
    """Payouts for every day of ``period`` in one set-based plan.

    ``history`` needs ``user_id, ts, balance, nxt`` (see
    ``wallet_history(..., with_next=True)``). A row with balance > min pays on
    day d iff ``date(ts) < d <= date(nxt)`` (it is the last movement before
    d's midnight), ``d >= first_hold_day(ts)`` and a rate exists in the
    look-back. Ties at one instant give an empty range to all but the last
    ``seq``. The explode emits exactly the output rows.
    """
    days = calendar(period)
    # one row per day of the period: bounded by the period length
    rate = F.broadcast(rate_asof(days, rates, cfg).select("payout_date", "daily_rate"))
    return eligible_days(history, period, cfg).join(rate, "payout_date").select(
        "payout_date", "user_id",
        bonus_amount("balance_at_start_of_day", "daily_rate").alias("calculated_amount"))


def payouts_since(history: DataFrame, rates: DataFrame, start: dt.date, end: dt.date,
                  cfg: Thresholds = DEFAULT, before: DataFrame | None = None) -> DataFrame:
    """Payouts of a (recent) period from a stored balance history, without
    rescanning its whole past: the rows inside the period (a literal
    ``ts >=`` filter, pushed to the parquet scan) plus, per user, the last
    row before it (an aggregate with map-side partial aggregation over four
    columns). Equals :func:`payouts_period` over the full history for the
    same period.

    ``history`` is a published ``wallet_history`` (``seq, user_id, ts,
    balance``); a daily run then sorts one period of movements and one
    snapshot row per user instead of re-sorting the whole ledger. ``before``
    may supply those snapshot rows (``seq, user_id, ts, balance``, newest per
    user strictly before ``start``), e.g. from a stored ledger state; then the
    older history is not read at all.
    """
    if start > end:
        raise ValueError(f"empty period: {start} comes after {end}")
    lo = F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz")
    h = history.select("seq", "user_id", "ts", "balance")
    inside = h.where(F.col("ts") >= lo)
    if before is not None:
        before = before.select("seq", "user_id", "ts", "balance")
    else:
        before = (h.where(F.col("ts") < lo)
                  .groupBy("user_id")
                  .agg(F.max(F.struct("ts", "seq", "balance")).alias("_s"))
                  .select(F.col("_s.seq").alias("seq"), "user_id", F.col("_s.ts").alias("ts"),
                          F.col("_s.balance").alias("balance")))
    relevant = keyed_scan(before.unionByName(inside), ["user_id"], ["ts", "seq"], {}, {"nxt": F.col("ts")})
    return payouts_period(relevant, rates, one_row_period(history.sparkSession, start, end), cfg)


def run_audit(history: DataFrame, rates: DataFrame, payouts: DataFrame, period: DataFrame,
              cfg: Thresholds = DEFAULT) -> DataFrame:
    """Per day: status, rate used and its source date, eligible users, records.

    Status is ``NO_RATE`` (no rate in the look-back), ``NO_HISTORY`` (no
    movement before the day), ``NONE_ELIGIBLE`` or ``PAID`` — the checks in
    the reference's order. Everything is bounded by the number of days.
    """
    days = calendar(period)
    rate = rate_asof(days, rates, cfg)
    first_move = history.agg(F.min("ts").alias("_first_ts"))
    counts = payouts.groupBy("payout_date").agg(
        F.count_distinct("user_id").alias("eligible_users"),
        F.count(F.lit(1)).alias("payout_records"),
        F.sum("calculated_amount").cast(MONEY).alias("total_amount"))
    a = with_scalars(days.join(F.broadcast(rate), "payout_date", "left"), first_move) \
        .join(F.broadcast(counts), "payout_date", "left")
    status = (F.when(F.col("daily_rate").isNull(), F.lit("NO_RATE"))
              .when(F.col("_first_ts").isNull() |
                    (F.col("_first_ts") >= F.col("payout_date").cast("timestamp_ntz")), F.lit("NO_HISTORY"))
              .when(F.coalesce(F.col("payout_records"), F.lit(0)) == 0, F.lit("NONE_ELIGIBLE"))
              .otherwise(F.lit("PAID")))
    return a.select(
        "payout_date", status.alias("status"), "daily_rate", "rate_source_date",
        F.coalesce("eligible_users", F.lit(0)).alias("eligible_users"),
        F.coalesce("payout_records", F.lit(0)).alias("payout_records"),
        F.coalesce("total_amount", F.lit(0).cast(MONEY)).alias("total_amount"))


def processed_days(audit: DataFrame) -> DataFrame:
    """Days the reference republishes (it returns early on NO_RATE / NO_HISTORY)."""
    return audit.where(F.col("status").isin("PAID", "NONE_ELIGIBLE")).select("payout_date")


def publishable_days(history: DataFrame, rates: DataFrame, period: DataFrame,
                     cfg: Thresholds = DEFAULT) -> DataFrame:
    """Days of the period that have a rate in the look-back and history before
    them: the days a run republishes. Unlike :func:`processed_days` it does not
    depend on the payouts, so the publish plan computes the payouts once."""
    days = calendar(period)
    rate = rate_asof(days, rates, cfg).select("payout_date")
    first_move = history.agg(F.min("ts").alias("_first_ts"))
    return (with_scalars(days.join(F.broadcast(rate), "payout_date"), first_move)
            .where(F.col("_first_ts") < F.col("payout_date").cast("timestamp_ntz"))
            .select("payout_date"))


def auto_period(history: DataFrame, as_of: dt.date) -> DataFrame:
    return resolve_period(period_bounds(history), as_of)
