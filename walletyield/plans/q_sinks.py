"""Queries: table maintenance (publish, upsert, insert-if-absent, keys)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from walletyield.config import WALLET_HISTORY
from walletyield.session import scratch_path

from walletyield.operators import sinks as S
from walletyield.operators.rates import annual_to_daily_rate
from walletyield.plans import fixtures as X
from walletyield.plans import payouts as P
from walletyield.plans.catalog import register

LO, HI = dt.date(2024, 1, 10), dt.date(2024, 1, 20)


@register("replace_days", """
WITH fm AS (SELECT min(ts) AS first_ts FROM cdc),
processed AS (SELECT ra.payout_date FROM rate_asof ra, fm
              WHERE ra.payout_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
                AND fm.first_ts < CAST(ra.payout_date AS TIMESTAMP))
SELECT payout_date, user_id, calculated_amount FROM payouts_seeded
WHERE payout_date NOT IN (SELECT payout_date FROM processed)
UNION ALL
SELECT payout_date, user_id, calculated_amount FROM payouts
WHERE payout_date IN (SELECT payout_date FROM processed)""")
def q_replace_days(spark, sf):
    target = X.payouts_seeded(spark, sf)
    h = X.history(spark, sf, with_next=True)
    rates = X.rates(spark, sf)
    period = P.resolve_period(_bounds(spark, sf), X.AS_OF, LO, HI)
    new = P.payouts_period(h, rates, period)
    return S.replace_days(target, new, P.publishable_days(X.cdc(spark, sf), rates, period))


def _bounds(spark, sf):
    from walletyield.operators.ledger import period_bounds
    return period_bounds(X.cdc(spark, sf))


@register("upsert_rates", """
WITH incoming AS (
  SELECT rate_date + 7 AS rate_date,
         CAST(CAST(round(pow(1 + (annual_rate + 0.5) / 100, CAST(1 AS DOUBLE) / 365) - 1, 10) AS DECIMAL(18,10)) AS DECIMAL(18,8)) AS daily_rate
  FROM annual_rates WHERE rate_date >= DATE '2024-01-15')
SELECT rate_date, daily_rate FROM rates WHERE rate_date NOT IN (SELECT rate_date FROM incoming)
UNION ALL SELECT rate_date, daily_rate FROM incoming""")
def q_upsert_rates(spark, sf):
    a = X.annual_rates(spark, sf).where(F.col("rate_date") >= F.lit(dt.date(2024, 1, 15)))
    incoming = annual_to_daily_rate(a.select(F.date_add("rate_date", 7).alias("rate_date"),
                                             (F.col("annual_rate") + F.lit(0.5)).alias("annual_rate")))
    from walletyield.operators.rates import upsert_rates
    return upsert_rates(X.rates(spark, sf), incoming)


@register("insert_if_absent_users", """
WITH cur AS (SELECT c_custkey AS user_id FROM customer),
inc AS (SELECT user_id FROM cdc UNION ALL SELECT user_id + 1000000 FROM cdc WHERE seq % 1000 = 999)
SELECT user_id FROM cur
UNION ALL
SELECT DISTINCT user_id FROM inc WHERE user_id NOT IN (SELECT user_id FROM cur)""")
def q_insert_if_absent_users(spark, sf):
    cur = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    c = X.cdc(spark, sf)
    inc = c.select("user_id").unionByName(
        c.where(F.col("seq") % 1000 == 999).select((F.col("user_id") + 1000000).alias("user_id")))
    return S.insert_if_absent(cur, inc, ["user_id"])


@register("assign_surrogate_key", """
SELECT row_number() OVER (ORDER BY payout_date, user_id) AS payout_id, payout_date, user_id, calculated_amount
FROM payouts""")
def q_assign_surrogate_key(spark, sf):
    return S.assign_surrogate_key(X.payouts(spark, sf), ["payout_date", "user_id"], 1, "payout_id")


@register("payouts_since", """
SELECT payout_date, user_id, calculated_amount FROM payouts
WHERE payout_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-30'""")
def q_payouts_since(spark, sf):
    """A daily-style run over a stored history: only the recent rows plus one
    snapshot row per user are read."""
    d = scratch_path(spark, f"since-{uuid.uuid4().hex[:8]}")
    S.write_table(X.history(spark, sf), d, WALLET_HISTORY, cluster_by=["user_id", "ts", "seq"])
    return P.payouts_since(spark.read.parquet(d), X.rates(spark, sf), dt.date(2024, 1, 20), dt.date(2024, 1, 30))
