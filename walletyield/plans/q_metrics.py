"""Queries: business metrics over the published payouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from walletyield.operators import metrics as M
from walletyield.plans import fixtures as X
from walletyield.plans.catalog import register

USER = 7

_MA_SQL = """
SELECT payout_date, {v},
       round(avg(CAST({v} AS DOUBLE)) OVER w, 6) AS avg_14d,
       round(100 * (CAST({v} AS DOUBLE) - avg(CAST({v} AS DOUBLE)) OVER w) / avg(CAST({v} AS DOUBLE)) OVER w, 6) AS pct_vs_14d_avg
FROM {t}
WINDOW w AS (ORDER BY payout_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"""


def _rounded(df):
    return df.withColumn("avg_14d", F.round("avg_14d", 6)).withColumn(
        "pct_vs_14d_avg", F.round("pct_vs_14d_avg", 6))


@register("daily_total_payout", "SELECT payout_date, total_payout FROM daily_totals")
def q_daily_total_payout(spark, sf):
    return M.daily_total_payout(X.payouts_seeded(spark, sf))


@register("daily_eligible_users", "SELECT payout_date, eligible_users_count FROM daily_users")
def q_daily_eligible_users(spark, sf):
    return M.daily_eligible_users(X.payouts_seeded(spark, sf))


@register("payout_total_ma14", _MA_SQL.format(v="total_payout", t="daily_totals"))
def q_payout_total_ma14(spark, sf):
    return _rounded(M.trailing_average(M.daily_total_payout(X.payouts_seeded(spark, sf)), "total_payout"))


@register("eligible_users_ma14", _MA_SQL.format(v="eligible_users_count", t="daily_users"))
def q_eligible_users_ma14(spark, sf):
    return _rounded(M.trailing_average(M.daily_eligible_users(X.payouts_seeded(spark, sf)),
                                       "eligible_users_count"))


@register("pct_vs_avg", """
SELECT payout_date,
       round(100 * (CAST(total_payout AS DOUBLE) - avg(CAST(total_payout AS DOUBLE)) OVER w) / avg(CAST(total_payout AS DOUBLE)) OVER w, 6) AS pct_vs_14d_avg
FROM daily_totals WINDOW w AS (ORDER BY payout_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""")
def q_pct_vs_avg(spark, sf):
    ma = M.trailing_average(M.daily_total_payout(X.payouts_seeded(spark, sf)), "total_payout")
    return ma.select("payout_date", F.round("pct_vs_14d_avg", 6).alias("pct_vs_14d_avg"))


@register("recent_14_days", "SELECT * FROM (" + _MA_SQL.format(v="total_payout", t="daily_totals")
          + ") ORDER BY payout_date DESC LIMIT 14")
def q_recent_14_days(spark, sf):
    ma = _rounded(M.trailing_average(M.daily_total_payout(X.payouts_seeded(spark, sf)), "total_payout"))
    return M.recent_days(ma, 14)


@register("last_day_vs_avg", """
SELECT payout_date, total_payout, avg_14d,
       CASE WHEN total_payout > avg_14d THEN 'above' ELSE 'below' END AS vs_avg
FROM (""" + _MA_SQL.format(v="total_payout", t="daily_totals") + """) ORDER BY payout_date DESC LIMIT 1""")
def q_last_day_vs_avg(spark, sf):
    ma = _rounded(M.trailing_average(M.daily_total_payout(X.payouts_seeded(spark, sf)), "total_payout"))
    return M.last_day_vs_avg(ma, "total_payout")


@register("user_payout_history", f"""
SELECT payout_date, user_id, calculated_amount FROM payouts WHERE user_id = {USER} ORDER BY payout_date DESC""")
def q_user_payout_history(spark, sf):
    return M.user_payout_history(X.payouts(spark, sf), USER)


@register("run_counts", """
SELECT payout_date, COUNT(DISTINCT user_id) AS eligible_users, COUNT(*) AS payout_records
FROM payouts GROUP BY payout_date""")
def q_run_counts(spark, sf):
    return X.payouts(spark, sf).groupBy("payout_date").agg(
        F.count_distinct("user_id").alias("eligible_users"),
        F.count(F.lit(1)).alias("payout_records"))


@register("sql_query", "SELECT payout_date, total_payout FROM daily_totals")
def q_sql_query(spark, sf):
    from walletyield.sources import register_views, sql_query
    register_views(spark, {"daily_bonus_payouts": X.payouts_seeded(spark, sf)})
    return sql_query(spark, """
        SELECT payout_date, CAST(SUM(calculated_amount) AS DECIMAL(18,2)) AS total_payout
        FROM daily_bonus_payouts WHERE payout_date >= :lo GROUP BY payout_date""",
                     {"lo": "1900-01-01"})


@register("payouts_by_date", """
SELECT payout_date, user_id, calculated_amount FROM payouts
WHERE payout_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' ORDER BY payout_date DESC""")
def q_payouts_by_date(spark, sf):
    """Consumers filter the payouts by date as well as by user."""
    import datetime as dt

    from walletyield.operators.metrics import payouts_between
    return payouts_between(X.payouts(spark, sf), dt.date(2024, 1, 10), dt.date(2024, 1, 12))
