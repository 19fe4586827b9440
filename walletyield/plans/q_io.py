"""Queries: sources, writers and the end-to-end pipeline, round-tripped
through files under the shared checkpoint folder (a fresh directory per run)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from walletyield.config import WALLET_HISTORY
from walletyield.operators import sinks as S
from walletyield.plans import fixtures as X
from walletyield.plans.catalog import register
from walletyield.plans.store import read_history, read_intervals, read_payouts
from walletyield.session import scratch_path
from walletyield.sources import read_cdc_csv, read_log_text, read_rate_series, read_table


def _dir(spark, tag):
    return scratch_path(spark, f"io-{tag}-{uuid.uuid4().hex[:8]}")


@register("read_cdc_csv", 'SELECT user_id, ts AS "timestamp", amount_change FROM cdc_raw')
def q_read_cdc_csv(spark, sf):
    d = _dir(spark, "csv")
    X.cdc_raw(spark, sf).select("user_id", F.col("ts").alias("timestamp"), "amount_change") \
        .write.option("header", True).csv(d)
    valid, _corrupt = read_cdc_csv(spark, d)
    return valid


@register("write_cdc_csv", """
SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
       CAST(amount_change AS VARCHAR) AS amount_change FROM cdc""")
def q_write_cdc_csv(spark, sf):
    d = _dir(spark, "wcsv")
    S.write_cdc_csv(X.cdc(spark, sf), d)
    return spark.read.option("header", True).schema(
        "user_id string, timestamp string, amount_change string").csv(d)


@register("build_history", "SELECT user_id, ts, amount_change, balance FROM history_s")
def q_build_history(spark, sf):
    from walletyield.plans.pipeline import build_history
    d = _dir(spark, "hist")
    S.write_cdc_csv(X.cdc(spark, sf), d)
    hist, _q, _r = build_history(spark, d, X.AS_OF)
    return hist.select("user_id", "ts", "amount_change", "balance")


@register("scan_table", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 100""")
def q_scan_table(spark, sf):
    df = read_table(spark, "parquet", f"{sf.rstrip('/')}/events.parquet")
    return df.where((F.col("event_type") == "purchase") & (F.col("value") > 100)) \
        .select("event_id", "user_id", "value")


@register("read_rate_series", """
SELECT rate_date, annual_rate FROM annual_rates WHERE rate_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'""")
def q_read_rate_series(spark, sf):
    d = _dir(spark, "rates")
    X.annual_rates(spark, sf).select("rate_date", F.col("annual_rate").cast("string").alias("annual_rate")) \
        .write.option("header", True).csv(d)
    r = read_rate_series(spark, "csv", d, dt.date(2024, 1, 1), dt.date(2024, 1, 20))
    return r.select("rate_date", F.col("annual_rate").cast("double").alias("annual_rate"))


@register("read_log_text", "SELECT value FROM log_lines")
def q_read_log_text(spark, sf):
    d = _dir(spark, "logs")
    X.log_lines(spark, sf).write.text(d)
    return read_log_text(spark, d)


@register("write_history_overwrite", "SELECT seq, user_id, ts, amount_change, balance FROM history")
def q_write_history_overwrite(spark, sf):
    d = _dir(spark, "wh")
    h = X.history(spark, sf)
    S.write_table(h.where(F.col("seq") < 0), d, WALLET_HISTORY)  # an older version
    S.write_table(h, d, WALLET_HISTORY)                           # replaced as a whole
    return spark.read.parquet(d)


def _feeds(spark, sf, d, **parts):
    """The CDC feed written as CSV, one folder for each condition, and the rate files."""
    c = X.cdc(spark, sf)
    for name, cond in parts.items():
        S.write_cdc_csv(c if cond is None else c.where(cond), f"{d}/{name}")
    X.annual_rates(spark, sf).select("rate_date", F.col("annual_rate").cast("string").alias("annual_rate")) \
        .write.option("header", True).csv(f"{d}/rates")


def _config(d, feed, run, start=None, end=None):
    from walletyield.plans.pipeline import PipelineConfig
    return PipelineConfig(f"{d}/{feed}", f"{d}/rates", f"{d}/tables", X.AS_OF, start=start, end=end, run_id=run)


CUT = dt.date(2024, 1, 15)


def _before_cut():
    return F.col("ts") < F.lit(dt.datetime.combine(CUT, dt.time())).cast("timestamp_ntz")


@register("pipeline_main", "SELECT payout_date, user_id, calculated_amount FROM payouts_s")
def q_pipeline_main(spark, sf):
    from walletyield.plans.pipeline import pipeline_main
    d = _dir(spark, "pipe")
    _feeds(spark, sf, d, raw=None)
    pipeline_main(spark, _config(d, "raw", 1))
    return read_payouts(spark, f"{d}/tables")


@register("pipeline_increment", "SELECT payout_date, user_id, calculated_amount FROM payouts_s")
def q_pipeline_increment(spark, sf):
    """Two daily-style runs (before / from 2024-01-15), each reading only its
    own CDC files; the published payouts equal the full run's."""
    from walletyield.plans.pipeline import pipeline_increment
    d = _dir(spark, "inc")
    _feeds(spark, sf, d, a=_before_cut(), b=~_before_cut())
    first, last = X.period(spark, sf).first()
    pipeline_increment(spark, _config(d, "a", 1, first, CUT - dt.timedelta(days=1)))
    pipeline_increment(spark, _config(d, "b", 2, CUT, last))
    return read_payouts(spark, f"{d}/tables")


def _late_runs(spark, sf):
    """A full run without every seventh old movement, then an increment that brings them
    together with the new ones and pays the new days only."""
    from walletyield.plans.pipeline import pipeline_increment, pipeline_main
    d = _dir(spark, "late")
    on_time = _before_cut() & (F.col("seq") % 7 != 3)
    _feeds(spark, sf, d, a=on_time, b=~on_time)
    first, last = X.period(spark, sf).first()
    pipeline_main(spark, _config(d, "a", 1, first, CUT - dt.timedelta(days=1)))
    pipeline_increment(spark, _config(d, "b", 2, CUT, last))
    return f"{d}/tables"


@register("payouts_late", "SELECT payout_date, user_id, calculated_amount FROM payouts_s")
def q_payouts_late(spark, sf):
    """Movements that arrive after their days were paid: the payouts equal those of one run
    over all movements."""
    return read_payouts(spark, _late_runs(spark, sf))


@register("published_totals", """
SELECT payout_date, count(*) AS payouts, CAST(sum(calculated_amount) AS DECIMAL(18,2)) AS total
FROM payouts_s GROUP BY payout_date""")
def q_published_totals(spark, sf):
    """SQL over the committed tables, opened as views."""
    from walletyield.plans.pipeline import open_tables
    from walletyield.sources import sql_query
    open_tables(spark, _late_runs(spark, sf))
    return sql_query(spark, """SELECT payout_date, count(*) AS payouts, CAST(sum(calculated_amount) AS DECIMAL(18,2)) AS total
                               FROM daily_bonus_payouts JOIN users USING (user_id) GROUP BY payout_date""")


@register("eligible_users_stored", """
SELECT 'day' AS span, payout_date AS since, COUNT(DISTINCT user_id) AS eligible_users FROM payouts_s GROUP BY payout_date
UNION ALL
SELECT 'month', CAST(date_trunc('month', payout_date) AS DATE), COUNT(DISTINCT user_id) FROM payouts_s GROUP BY 2""")
def q_eligible_users_stored(spark, sf):
    """Distinct users of days and months from the bitmaps stored by day, after late movements."""
    from walletyield.operators.bitmaps import users_by_day, users_by_month
    from walletyield.plans.store import read_day_users
    bitmaps = read_day_users(spark, _late_runs(spark, sf))
    return (users_by_day(bitmaps).select(F.lit("day").alias("span"), F.col("payout_date").alias("since"), "eligible_users")
            .unionByName(users_by_month(bitmaps).select(F.lit("month").alias("span"), F.col("month").alias("since"), "eligible_users")))


@register("stored_ids", """
SELECT 'wallet_history' AS table_name, count(*) AS n, count(*) AS ids, CAST(1 AS BIGINT) AS lowest, count(*) AS highest FROM history_s
UNION ALL
SELECT 'daily_bonus_payouts', count(*), count(*), CAST(1 AS BIGINT), count(*) FROM payouts_s""")
def q_stored_ids(spark, sf):
    """``history_id`` and ``payout_id`` of a full run: dense and unique, from the files' blocks."""
    from walletyield.plans.pipeline import pipeline_main
    d = _dir(spark, "ids")
    _feeds(spark, sf, d, raw=None)
    pipeline_main(spark, _config(d, "raw", 1))

    def summary(rows, id_col, name):
        return rows.agg(F.count("*").alias("n"), F.count_distinct(id_col).alias("ids"), F.min(id_col).alias("lowest"),
                        F.max(id_col).alias("highest")).select(F.lit(name).alias("table_name"), "n", "ids", "lowest", "highest")

    return (summary(read_history(spark, f"{d}/tables", ids=True), "history_id", "wallet_history")
            .unionByName(summary(read_payouts(spark, f"{d}/tables", ids=True), "payout_id", "daily_bonus_payouts")))


@register("stored_validity", """
SELECT user_id, ts, amount_change, balance, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS nxt FROM history_s""")
def q_stored_validity(spark, sf):
    """Ends of validity of a ledger of two runs and its compaction, read without a sort."""
    from walletyield.plans.pipeline import compact_history, pipeline_increment, pipeline_main
    d = _dir(spark, "validity")
    _feeds(spark, sf, d, a=_before_cut(), b=~_before_cut())
    first, last = X.period(spark, sf).first()
    pipeline_main(spark, _config(d, "a", 1, first, CUT - dt.timedelta(days=1)))
    pipeline_increment(spark, _config(d, "b", 2, CUT, last))
    compact_history(spark, f"{d}/tables", 3)
    return read_intervals(spark, f"{d}/tables").select("user_id", "ts", "amount_change", "balance", "nxt")
