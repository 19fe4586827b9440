"""Queries: data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from walletyield.operators import quality as Q
from walletyield.plans import fixtures as X
from walletyield.plans.catalog import register


@register("duplicate_payouts", """
SELECT payout_date, user_id, COUNT(*) AS payment_count
FROM payouts_seeded GROUP BY payout_date, user_id HAVING COUNT(*) > 1
ORDER BY payout_date DESC, user_id LIMIT 10""")
def q_duplicate_payouts(spark, sf):
    return Q.duplicate_keys(X.payouts_seeded(spark, sf), ["payout_date", "user_id"],
                            limit=10, order=[F.col("payout_date").desc()])


@register("unique_key_violations", """
SELECT payout_date, user_id, COUNT(*) AS n FROM payouts_seeded
WHERE payout_date IS NOT NULL AND user_id IS NOT NULL
GROUP BY payout_date, user_id HAVING COUNT(*) > 1""")
def q_unique_key_violations(spark, sf):
    return Q.unique_key_violations(X.payouts_seeded(spark, sf), ["payout_date", "user_id"])


@register("not_null_violations", """
WITH p AS (SELECT seq, user_id, date_trunc('second', try_cast(ts AS TIMESTAMP)) AS ts, amount_change FROM cdc_raw)
SELECT 'seq' AS column_name, count(*) - count(seq) AS null_count FROM p
UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM p
UNION ALL SELECT 'ts', count(*) - count(ts) FROM p
UNION ALL SELECT 'amount_change', count(*) - count(amount_change) FROM p""")
def q_not_null_violations(spark, sf):
    from walletyield.functions import parse_cdc_ts
    p = X.cdc_raw(spark, sf).withColumn("ts", parse_cdc_ts("ts"))
    return Q.not_null_violations(p, ["seq", "user_id", "ts", "amount_change"])


@register("fk_orphans", """
WITH child AS (SELECT seq, user_id FROM cdc
               UNION ALL SELECT seq, user_id + 1000000 FROM cdc WHERE seq % 1000 = 999)
SELECT seq, user_id FROM child
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)""")
def q_fk_orphans(spark, sf):
    c = X.cdc(spark, sf).select("seq", "user_id")
    child = c.unionByName(c.where(F.col("seq") % 1000 == 999)
                          .select("seq", (F.col("user_id") + 1000000).alias("user_id")))
    return Q.fk_orphans(child, X.table(spark, sf, "customer"), "user_id", "c_custkey")


_RULE_SQL = """
SELECT p.payout_date, p.user_id, p.calculated_amount, h.balance AS balance_at_start_of_day, h.ts AS last_movement
FROM payouts_seeded p ASOF JOIN history h
  ON p.user_id = h.user_id AND CAST(p.payout_date AS TIMESTAMP) > h.ts
WHERE p.calculated_amount > 0
  AND ({rule})"""


@register("dq_rule_check", _RULE_SQL.format(
    rule="h.balance <= 100 AND CAST(p.payout_date AS TIMESTAMP) - h.ts < INTERVAL 24 HOUR"))
def q_dq_rule_check(spark, sf):
    return Q.rule_check(X.payouts_seeded(spark, sf), X.history(spark, sf), mode="both")


@register("dq_rule_check_any", _RULE_SQL.format(
    rule="h.balance <= 100 OR CAST(p.payout_date AS TIMESTAMP) - h.ts < INTERVAL 24 HOUR"))
def q_dq_rule_check_any(spark, sf):
    return Q.rule_check(X.payouts_seeded(spark, sf), X.history(spark, sf), mode="any")


@register("cdc_validation", """
WITH p AS (SELECT seq, user_id, date_trunc('second', try_cast(ts AS TIMESTAMP)) AS ts, amount_change FROM cdc_raw)
SELECT seq, CASE WHEN user_id IS NULL THEN 'missing user_id'
                 WHEN ts IS NULL THEN 'missing timestamp'
                 WHEN amount_change IS NULL THEN 'missing amount_change'
                 WHEN amount_change = 0 THEN 'zero amount_change' END AS reason
FROM p WHERE user_id IS NULL OR ts IS NULL OR amount_change IS NULL OR amount_change = 0""")
def q_cdc_validation(spark, sf):
    from walletyield.functions import parse_cdc_ts
    p = X.cdc_raw(spark, sf).withColumn("ts", parse_cdc_ts("ts"))
    _, rejected = Q.cdc_validation(p)
    return rejected.select("seq", "reason")


@register("limit_10", _RULE_SQL.format(
    rule="h.balance <= 100 AND CAST(p.payout_date AS TIMESTAMP) - h.ts < INTERVAL 24 HOUR")
    + "\nORDER BY p.payout_date DESC, p.user_id, p.calculated_amount, h.ts LIMIT 10")
def q_limit_10(spark, sf):
    """The dashboard's LIMIT 10 on the rule check, under a total order."""
    out = Q.rule_check(X.payouts_seeded(spark, sf), X.history(spark, sf), mode="both")
    return out.orderBy(F.col("payout_date").desc(), "user_id", "calculated_amount", "last_movement").limit(10)


@register("table_checks", """
SELECT 'wallet_history' AS table_name, 'not_null' AS "check", 'user_id' AS columns, count(*) - count(user_id) AS violations FROM history
UNION ALL SELECT 'wallet_history', 'not_null', 'ts', count(*) - count(ts) FROM history
UNION ALL SELECT 'wallet_history', 'not_null', 'balance', count(*) - count(balance) FROM history
UNION ALL SELECT 'wallet_history', 'unique', 'user_id,ts,seq', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM history WHERE user_id IS NOT NULL AND ts IS NOT NULL AND seq IS NOT NULL
   GROUP BY user_id, ts, seq HAVING count(*) > 1)
UNION ALL SELECT 'wallet_history', 'unique', 'user_id,ts', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM history WHERE user_id IS NOT NULL AND ts IS NOT NULL
   GROUP BY user_id, ts HAVING count(*) > 1)
UNION ALL SELECT 'daily_bonus_payouts', 'not_null', 'payout_date', count(*) - count(payout_date) FROM payouts_seeded
UNION ALL SELECT 'daily_bonus_payouts', 'not_null', 'user_id', count(*) - count(user_id) FROM payouts_seeded
UNION ALL SELECT 'daily_bonus_payouts', 'not_null', 'calculated_amount', count(*) - count(calculated_amount) FROM payouts_seeded
UNION ALL SELECT 'daily_bonus_payouts', 'unique', 'payout_date,user_id', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM payouts_seeded WHERE payout_date IS NOT NULL AND user_id IS NOT NULL
   GROUP BY payout_date, user_id HAVING count(*) > 1)
UNION ALL SELECT 'daily_interest_rates', 'not_null', 'rate_date', count(*) - count(rate_date) FROM rates
UNION ALL SELECT 'daily_interest_rates', 'not_null', 'daily_rate', count(*) - count(daily_rate) FROM rates
UNION ALL SELECT 'daily_interest_rates', 'unique', 'rate_date', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM rates WHERE rate_date IS NOT NULL GROUP BY rate_date HAVING count(*) > 1)
UNION ALL SELECT 'users', 'not_null', 'user_id', count(*) - count(c_custkey) FROM customer
UNION ALL SELECT 'users', 'unique', 'user_id', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING count(*) > 1)""")
def q_table_checks(spark, sf):
    """Declared NOT NULL / UNIQUE constraints over the four tables."""
    return Q.table_checks({
        "wallet_history": X.history(spark, sf),
        "daily_bonus_payouts": X.payouts_seeded(spark, sf),
        "daily_interest_rates": X.rates(spark, sf),
        "users": X.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")),
    })
