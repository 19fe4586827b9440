import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F


def cdc_frame(spark, rows):
    """rows: (seq, user_id, 'YYYY-mm-dd HH:MM:SS[.ffffff]', amount or None)."""
    data = []
    for seq, uid, ts, amt in rows:
        t = dt.datetime.fromisoformat(ts) if ts else None
        data.append((seq, uid, t, None if amt is None else Decimal(str(amt))))
    return spark.createDataFrame(
        data, "seq long, user_id long, ts timestamp_ntz, amount_change decimal(18,2)")


def rates_frame(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), Decimal(str(r))) for d, r in rows],
                                 "rate_date date, daily_rate decimal(18,8)")


def collect_sorted(df, *cols):
    return [tuple(r) for r in df.orderBy(*cols).collect()]


def period_frame(spark, lo, hi):
    from walletyield.plans.payouts import one_row_period
    return one_row_period(spark, dt.date.fromisoformat(lo), dt.date.fromisoformat(hi))


__all__ = ["cdc_frame", "rates_frame", "collect_sorted", "period_frame", "F"]
