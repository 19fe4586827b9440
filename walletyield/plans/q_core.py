"""Queries: sources, ledger, rates, joins and the payout pipeline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from walletyield.config import MONEY
from walletyield.functions import bonus_amount, exact_daily_rate, iso_seconds
from walletyield.operators import ledger as L
from walletyield.operators import rates as R
from walletyield.operators.asof import asof_join
from walletyield.operators.common import with_scalars
from walletyield.plans import fixtures as X
from walletyield.plans import payouts as P
from walletyield.plans.catalog import register

DAY = dt.date(2024, 1, 15)


@register("wallet_history", """
SELECT seq, user_id, ts, amount_change, balance FROM history""")
def q_wallet_history(spark, sf):
    return X.history(spark, sf).select("seq", "user_id", "ts", "amount_change", "balance")


@register("annual_to_daily_rate", "SELECT rate_date, daily_rate FROM rates")
def q_annual_to_daily_rate(spark, sf):
    return X.rates(spark, sf)


@register("exact_daily_rate", """
SELECT rate_date, CAST(round(power(1.0::DOUBLE + annual_rate / 100.0::DOUBLE, 1.0::DOUBLE / 365.0::DOUBLE) - 1.0::DOUBLE, 10) AS DECIMAL(18,10)) AS daily_rate
FROM annual_rates""")
def q_exact_daily_rate(spark, sf):
    """The daily rate at the 10 decimals it is computed with."""
    return X.annual_rates(spark, sf).select("rate_date", exact_daily_rate("annual_rate").alias("daily_rate"))


@register("rate_asof", "SELECT payout_date, daily_rate, rate_source_date FROM rate_asof")
def q_rate_asof(spark, sf):
    days = P.calendar(X.period(spark, sf))
    return R.rate_asof(days, X.rates(spark, sf))


@register("payouts_period", "SELECT payout_date, user_id, calculated_amount FROM payouts")
def q_payouts_period(spark, sf):
    return X.payouts(spark, sf)


# --- sources -------------------------------------------------------------

@register("period_bounds", "SELECT min_date, max_date FROM bounds")
def q_period_bounds(spark, sf):
    return L.period_bounds(X.cdc(spark, sf))


@register("user_ids_range", """
SELECT unnest(range(1, m + 1)) AS user_id FROM (SELECT max(c_custkey) AS m FROM customer)""")
def q_user_ids_range(spark, sf):
    from walletyield.sources import user_ids_range
    n = X.table(spark, sf, "customer").agg(F.max("c_custkey")).first()[0]
    return user_ids_range(spark, int(n))


# --- scalar functions ----------------------------------------------------

@register("parse_cdc_ts", """
SELECT seq, ts AS ts_text, date_trunc('second', try_cast(ts AS TIMESTAMP)) AS parsed_ts FROM cdc_raw""")
def q_parse_cdc_ts(spark, sf):
    from walletyield.functions import parse_cdc_ts
    return X.cdc_raw(spark, sf).select("seq", F.col("ts").alias("ts_text"), parse_cdc_ts("ts").alias("parsed_ts"))


@register("default_null_ts", """
SELECT seq, user_id,
       coalesce(date_trunc('second', try_cast(ts AS TIMESTAMP)), TIMESTAMP '2100-01-01 00:00:00') AS ts,
       amount_change
FROM cdc_raw""")
def q_default_null_ts(spark, sf):
    valid, _ = L.parse_cdc(X.cdc_raw(spark, sf), X.AS_OF_TS)
    return valid


@register("project_rename_drop", """
SELECT user_id, balance AS balance_at_start_of_day, ts AS last_movement_timestamp FROM history""")
def q_project_rename_drop(spark, sf):
    return (X.history(spark, sf).withColumnRenamed("balance", "balance_at_start_of_day")
            .withColumnRenamed("ts", "last_movement_timestamp")
            .drop("seq", "amount_change"))


@register("before_day_start", """
SELECT seq, user_id, ts FROM cdc WHERE ts < TIMESTAMP '2024-01-15 00:00:00'""")
def q_before_day_start(spark, sf):
    from walletyield.functions import before_day_start
    return X.cdc(spark, sf).where(before_day_start("ts", F.lit(DAY))).select("seq", "user_id", "ts")


@register("iso_format", """
SELECT seq, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_iso, date_trunc('second', ts) AS ts_second,
       amount_change
FROM cdc""")
def q_iso_format(spark, sf):
    from walletyield.functions import trunc_second
    return X.cdc(spark, sf).select("seq", iso_seconds("ts").alias("ts_iso"),
                                   trunc_second("ts").alias("ts_second"),
                                   F.round("amount_change", 2).cast(MONEY).alias("amount_change"))


@register("reject_bad_rates", """
WITH raw AS (
  SELECT rate_date,
         CASE day(rate_date) WHEN 5 THEN 'NaN' WHEN 12 THEN 'abc' WHEN 19 THEN '-150'
              ELSE CAST(annual_rate AS VARCHAR) END AS annual_rate
  FROM annual_rates)
SELECT rate_date,
       coalesce(try_cast(annual_rate AS DECIMAL(18,8)) > -100, false) AS accepted
FROM raw""")
def q_reject_bad_rates(spark, sf):
    good, bad = R.reject_bad_rates(_raw_rate_text(spark, sf))
    return good.select("rate_date", F.lit(True).alias("accepted")).unionByName(
        bad.select("rate_date", F.lit(False).alias("accepted")))


def _raw_rate_text(spark, sf):
    a = X.annual_rates(spark, sf)
    text = (F.when(F.dayofmonth("rate_date") == 5, F.lit("NaN"))
            .when(F.dayofmonth("rate_date") == 12, F.lit("abc"))
            .when(F.dayofmonth("rate_date") == 19, F.lit("-150"))
            .otherwise(F.col("annual_rate").cast("string")))
    return a.select("rate_date", text.alias("annual_rate"))


@register("clamp_rate_range", """
SELECT min_date - 7 AS start_date, least(max_date + 1, DATE '2100-01-01') AS end_date FROM bounds""")
def q_clamp_rate_range(spark, sf):
    return R.clamp_rate_range(L.period_bounds(X.cdc(spark, sf)), X.AS_OF)


@register("resolve_period", "SELECT start_date, end_date FROM period")
def q_resolve_period(spark, sf):
    return X.period(spark, sf)


@register("calendar", "SELECT payout_date FROM days")
def q_calendar(spark, sf):
    return P.calendar(X.period(spark, sf))


@register("missing_rate_days", """
WITH rng AS (SELECT min_date - 7 AS lo, least(max_date + 1, DATE '2100-01-01') AS hi FROM bounds),
cal AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS rate_date FROM rng)
SELECT rate_date FROM cal WHERE rate_date NOT IN (SELECT rate_date FROM rates)""")
def q_missing_rate_days(spark, sf):
    rng = R.clamp_rate_range(L.period_bounds(X.cdc(spark, sf)), X.AS_OF)
    return R.missing_rate_days(P.calendar(rng, "rate_date"), X.rates(spark, sf))


# --- snapshot, eligibility, amounts ----------------------------------------

@register("latest_snapshot", """
SELECT user_id, balance AS balance_at_start_of_day, ts AS last_movement_timestamp FROM (
  SELECT user_id, balance, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS rn
  FROM history WHERE ts < TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1""")
def q_latest_snapshot(spark, sf):
    return L.latest_snapshot(X.history(spark, sf, with_next=True), DAY)


@register("eligible_filter", """
SELECT payout_date, user_id, balance_at_start_of_day, last_movement_timestamp FROM eligible""")
def q_eligible_filter(spark, sf):
    return P.eligible_days(X.history(spark, sf, with_next=True), X.period(spark, sf))


@register("bonus_amount", """
SELECT e.payout_date, e.user_id, e.balance_at_start_of_day, ra.daily_rate,
       CAST(e.balance_at_start_of_day * ra.daily_rate AS DECIMAL(18,2)) AS calculated_amount
FROM eligible e JOIN rate_asof ra ON ra.payout_date = e.payout_date""")
def q_bonus_amount(spark, sf):
    days = P.calendar(X.period(spark, sf))
    rate = R.rate_asof(days, X.rates(spark, sf)).select("payout_date", "daily_rate")
    e = P.eligible_days(X.history(spark, sf, with_next=True), X.period(spark, sf))
    return e.join(F.broadcast(rate), "payout_date").select(
        "payout_date", "user_id", "balance_at_start_of_day", "daily_rate",
        bonus_amount("balance_at_start_of_day", "daily_rate").alias("calculated_amount"))


@register("payouts_day", """
SELECT payout_date, user_id, calculated_amount FROM payouts WHERE payout_date = DATE '2024-01-15'""")
def q_payouts_day(spark, sf):
    return P.payouts_day(X.history(spark, sf, with_next=True), X.rates(spark, sf), DAY)


@register("attach_constant_rate", """
SELECT user_id, balance_at_start_of_day, (SELECT daily_rate FROM rate_asof WHERE payout_date = DATE '2024-01-15') AS current_daily_rate
FROM snapshots WHERE payout_date = DATE '2024-01-15'""")
def q_attach_constant_rate(spark, sf):
    rate = R.rate_asof(P.calendar_range(spark, DAY, DAY), X.rates(spark, sf))
    snap = L.latest_snapshot(X.history(spark, sf, with_next=True), DAY)
    return with_scalars(snap, rate.select(F.col("daily_rate").alias("current_daily_rate"))) \
        .select("user_id", "balance_at_start_of_day", "current_daily_rate")


@register("rate_lookup_filter", """
SELECT rate_date, daily_rate FROM rates WHERE rate_date = DATE '2024-01-15'""")
def q_rate_lookup_filter(spark, sf):
    return X.rates(spark, sf).where(F.col("rate_date") == F.lit(DAY))


# --- joins -------------------------------------------------------------------

@register("validity_intervals", """
SELECT seq, user_id, ts, balance, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS valid_to FROM history""")
def q_validity_intervals(spark, sf):
    return L.validity_intervals(X.history(spark, sf)).select("seq", "user_id", "ts", "balance", "valid_to")


@register("validity_join", """
WITH v AS (SELECT seq, user_id, ts, balance, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS nxt FROM history)
SELECT d.payout_date AS day, v.user_id, v.seq, v.balance
FROM v JOIN days d ON v.ts < CAST(d.payout_date AS TIMESTAMP)
 AND (v.nxt IS NULL OR v.nxt >= CAST(d.payout_date AS TIMESTAMP))""")
def q_validity_join(spark, sf):
    v = L.validity_days(X.history(spark, sf, with_next=True), X.period(spark, sf))
    return v.select("day", "user_id", "seq", "balance")


@register("asof_join", """
SELECT p.payout_date, p.user_id, p.calculated_amount, h.balance, h.ts AS last_movement
FROM payouts_seeded p ASOF LEFT JOIN history h
  ON p.user_id = h.user_id AND CAST(p.payout_date AS TIMESTAMP) > h.ts""")
def q_asof_join(spark, sf):
    p = X.payouts_seeded(spark, sf).withColumn("_d", F.col("payout_date").cast("timestamp_ntz"))
    h = X.history(spark, sf).select("user_id", "ts", "seq", "balance")
    out = asof_join(p, h, ["user_id"], "_d", "ts", strict=True, right_seq="seq",
                    right_cols=["balance", "ts"])
    return out.select("payout_date", "user_id", "calculated_amount", "balance",
                      F.col("ts").alias("last_movement"))


# --- ledger windows ------------------------------------------------------------

@register("monotonic_timestamps", """
WITH n AS (SELECT seq, ts, row_number() OVER (ORDER BY ts, seq) AS rn FROM cdc)
SELECT seq, make_timestamp(1000000 * rn + max(epoch_us(ts) - 1000000 * rn)
           OVER (ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS ts
FROM n""")
def q_monotonic_timestamps(spark, sf):
    return L.monotonic_timestamps(X.cdc(spark, sf).select("seq", "ts"), "ts", ["seq"])


@register("sorted_events", "SELECT seq, user_id, ts, amount_change FROM cdc ORDER BY ts, seq")
def q_sorted_events(spark, sf):
    return L.sorted_events(X.cdc(spark, sf))


# --- pipeline ---------------------------------------------------------------

@register("run_audit", """
WITH cnt AS (SELECT payout_date, COUNT(DISTINCT user_id) AS eligible_users, COUNT(*) AS payout_records,
                    CAST(SUM(calculated_amount) AS DECIMAL(18,2)) AS total_amount
             FROM payouts GROUP BY payout_date),
fm AS (SELECT min(ts) AS first_ts FROM cdc)
SELECT d.payout_date,
       CASE WHEN ra.daily_rate IS NULL THEN 'NO_RATE'
            WHEN fm.first_ts IS NULL OR fm.first_ts >= CAST(d.payout_date AS TIMESTAMP) THEN 'NO_HISTORY'
            WHEN coalesce(cnt.payout_records, 0) = 0 THEN 'NONE_ELIGIBLE'
            ELSE 'PAID' END AS status,
       ra.daily_rate, ra.rate_source_date,
       coalesce(cnt.eligible_users, 0) AS eligible_users,
       coalesce(cnt.payout_records, 0) AS payout_records,
       coalesce(cnt.total_amount, CAST(0 AS DECIMAL(18,2))) AS total_amount
FROM days d CROSS JOIN fm
LEFT JOIN rate_asof ra ON ra.payout_date = d.payout_date
LEFT JOIN cnt ON cnt.payout_date = d.payout_date""")
def q_run_audit(spark, sf):
    h = X.history(spark, sf, with_next=True)
    period = X.period(spark, sf)
    rates = X.rates(spark, sf)
    return P.run_audit(h, rates, P.payouts_period(h, rates, period), period)


@register("load_rates", """
WITH raw AS (
  SELECT rate_date,
         CASE day(rate_date) WHEN 5 THEN 'NaN' WHEN 12 THEN 'abc' WHEN 19 THEN '-150'
              ELSE CAST(annual_rate AS VARCHAR) END AS annual_rate
  FROM annual_rates),
rng AS (SELECT min_date - 7 AS lo, least(max_date + 1, DATE '2100-01-01') AS hi FROM bounds),
good AS (SELECT raw.rate_date, CAST(annual_rate AS DOUBLE) AS annual_rate FROM raw, rng
         WHERE raw.rate_date BETWEEN rng.lo AND rng.hi
           AND coalesce(try_cast(annual_rate AS DECIMAL(18,8)) > -100, false)),
incoming AS (SELECT rate_date,
       CAST(CAST(round(pow(1 + annual_rate / 100, CAST(1 AS DOUBLE) / 365) - 1, 10) AS DECIMAL(18,10)) AS DECIMAL(18,8)) AS daily_rate
       FROM good),
cur AS (SELECT rate_date - 30 AS rate_date, daily_rate FROM rates)
SELECT rate_date, daily_rate FROM cur WHERE rate_date NOT IN (SELECT rate_date FROM incoming)
UNION ALL SELECT rate_date, daily_rate FROM incoming""")
def q_load_rates(spark, sf):
    current = X.rates(spark, sf).select(F.date_sub("rate_date", 30).alias("rate_date"), "daily_rate")
    table, _ = R.load_rates(_raw_rate_text(spark, sf), L.period_bounds(X.cdc(spark, sf)), current, X.AS_OF)
    return table


@register("monotonic_timestamps_by_user", """
WITH n AS (SELECT seq, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS rn FROM cdc)
SELECT seq, user_id, make_timestamp(1000000 * rn + max(epoch_us(ts) - 1000000 * rn)
           OVER (PARTITION BY user_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS ts
FROM n""")
def q_monotonic_timestamps_by_user(spark, sf):
    return L.monotonic_timestamps(X.cdc(spark, sf).select("seq", "user_id", "ts"), "ts", ["seq"], by=["user_id"])


# --- the skewed ledger: hot-key detection always on, so the split path runs ---

SKEW: dict = {}


@register("wallet_history_skewed", "SELECT seq, user_id, ts, amount_change, balance FROM history_k")
def q_wallet_history_skewed(spark, sf):
    return L.wallet_history(X.cdc_skewed(spark, sf), **SKEW).select(
        "seq", "user_id", "ts", "amount_change", "balance")


@register("payouts_period_skewed", "SELECT payout_date, user_id, calculated_amount FROM payouts_k")
def q_payouts_period_skewed(spark, sf):
    c = X.cdc_skewed(spark, sf)
    h = L.wallet_history(c, with_next=True, **SKEW)
    return P.payouts_period(h, X.rates(spark, sf), P.auto_period(c, X.AS_OF))


@register("extend_history", """
SELECT seq, user_id, ts, amount_change, balance FROM history WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""")
def q_extend_history(spark, sf):
    """Incremental balances: the state after the first half of the ledger
    plus the second half's movements gives the second half's history."""
    c = X.cdc(spark, sf)
    cut = F.lit(DAY).cast("timestamp_ntz")
    state = L.ledger_state(L.wallet_history(c.where(F.col("ts") < cut)))
    hist, _late = L.extend_history(state, c.where(F.col("ts") >= cut))
    return hist.select("seq", "user_id", "ts", "amount_change", "balance")
