"""Business metrics over the payouts table.

Per-day aggregates use map-side partial aggregation. Trailing averages and
the newest-day flags run on the daily aggregate, which has one row per day
(bounded by the calendar span), so an unpartitioned window there is cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletyield.config import DEFAULT, MONEY
from walletyield.functions import pct_vs_avg


def daily_total_payout(payouts: DataFrame) -> DataFrame:
    return payouts.groupBy("payout_date").agg(
        F.sum("calculated_amount").cast(MONEY).alias("total_payout"))


def daily_eligible_users(payouts: DataFrame) -> DataFrame:
    return payouts.groupBy("payout_date").agg(F.count_distinct("user_id").alias("eligible_users_count"))


def trailing_average(daily: DataFrame, value: str, rows: int = DEFAULT.ma_rows,
                     order: str = "payout_date") -> DataFrame:
    """``rows``-row trailing mean (current row included, min 1 row) and % vs it."""
    w = Window.orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    avg = F.avg(F.col(value).cast("double")).over(w)
    return (daily.withColumn("avg_14d", avg)
            .withColumn("pct_vs_14d_avg", pct_vs_avg(value, "avg_14d")))


def recent_days(daily: DataFrame, n: int = 14, order: str = "payout_date") -> DataFrame:
    """Newest ``n`` days, newest first (a top-k: TakeOrderedAndProject)."""
    return daily.orderBy(F.col(order).desc()).limit(n)


def last_day_vs_avg(with_avg: DataFrame, value: str, avg: str = "avg_14d",
                    order: str = "payout_date") -> DataFrame:
    """The newest day flagged ``above`` its trailing average, else ``below``."""
    last = with_avg.orderBy(F.col(order).desc()).limit(1)
    return last.select(order, value, avg,
                       F.when(F.col(value) > F.col(avg), F.lit("above")).otherwise(F.lit("below"))
                       .alias("vs_avg"))


def user_payout_history(payouts: DataFrame, user_id: int, lo=None, hi=None) -> DataFrame:
    """One user's payouts, newest first; optional inclusive date bounds."""
    out = payouts.where(F.col("user_id") == F.lit(user_id))
    if lo is not None:
        out = out.where(F.col("payout_date") >= F.lit(lo).cast("date"))
    if hi is not None:
        out = out.where(F.col("payout_date") <= F.lit(hi).cast("date"))
    return out.orderBy(F.col("payout_date").desc())


def payouts_between(payouts: DataFrame, lo, hi) -> DataFrame:
    """Payouts of every user in ``[lo, hi]`` (inclusive), newest first; the
    date predicate reaches a payouts table partitioned by day as partition
    pruning."""
    return (payouts.where(F.col("payout_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
            .orderBy(F.col("payout_date").desc(), "user_id"))
