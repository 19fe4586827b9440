"""Ledger operators: CDC parsing, running balances, snapshots, intervals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletyield.config import MONEY
from walletyield.functions import before_day_start, parse_cdc_ts, trunc_second
from walletyield.operators.common import with_scalars
from walletyield.operators.scan import keyed_scan


def parse_cdc(raw: DataFrame, as_of: dt.datetime, ts_col: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Parse CDC text timestamps; NULL/unparseable -> ``as_of``.

    Returns ``(valid, rejected)``: ``valid`` keeps every row (as the reference
    does) with ``ts`` defaulted; ``rejected`` lists the rows whose timestamp
    text was present but unparseable, with the original text.
    """
    dtype = raw.schema[ts_col].dataType
    if isinstance(dtype, T.StringType):
        parsed = parse_cdc_ts(ts_col)
    else:
        parsed = F.col(ts_col).cast("timestamp_ntz")
    out = raw.withColumn("_raw_ts", F.col(ts_col).cast("string")).withColumn("_parsed", parsed)
    valid = out.withColumn(ts_col, default_null_ts("_parsed", as_of)).drop("_raw_ts", "_parsed")
    rejected = out.where(F.col("_parsed").isNull() & F.col("_raw_ts").isNotNull()) \
        .withColumn("reason", F.lit("unparseable timestamp")) \
        .drop("_parsed").withColumnRenamed("_raw_ts", "raw_ts")
    return valid, rejected


def default_null_ts(ts, as_of: dt.datetime):
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(c, F.lit(as_of).cast("timestamp_ntz"))


def wallet_history(cdc: DataFrame, key: str = "user_id", ts: str = "ts",
                   amount: str = "amount_change", seq: str = "seq",
                   with_next: bool = False, **scan_opts) -> DataFrame:
    """Running balance per user ordered by (ts, seq); keeps ``amount_change``.

    NULL amounts are skipped by the sum but stay as movements. Skewed users
    are split across tasks by :func:`keyed_scan`. ``with_next`` adds ``nxt``,
    the next movement's timestamp (the end of this balance's validity).
    """
    leads = {"nxt": F.col(ts)} if with_next else None
    out = keyed_scan(cdc, [key], [ts, seq], {"balance": ("sum", F.col(amount))}, leads, **scan_opts)
    return out.withColumn("balance", F.col("balance").cast(MONEY))


def ledger_state(history: DataFrame, key: str = "user_id", ts: str = "ts",
                 seq: str = "seq") -> DataFrame:
    """Newest ``(seq, ts, balance)`` per user: the carry-in for the next increment.

    One row per user; a max over a struct with map-side partial aggregation.
    """
    return (history.groupBy(key)
            .agg(F.max(F.struct(F.col(ts), F.col(seq), F.col("balance"))).alias("_s"))
            .select(F.col(f"_s.{seq}").alias(seq), key, F.col(f"_s.{ts}").alias(ts),
                    F.col("_s.balance").alias("balance")))


def extend_history(state: DataFrame, increment: DataFrame, key: str = "user_id", ts: str = "ts",
                   seq: str = "seq", amount: str = "amount_change", **scan_opts) -> tuple[DataFrame, DataFrame]:
    """Balances for new movements only, from the per-user state of the last run.

    Returns ``(history_rows, late)``. Each new row's balance is the prior
    balance plus the running sum of the new rows: the prior balance rides
    along as a column from one join with the state, so the increment is
    shuffled once (by user) and the old history is not read at all. Rows not
    after the user's stored newest movement can't be placed without
    rewriting published history; they are returned as ``late``.
    """
    st = state.select(key, F.col("balance").alias("_pb"), F.col(ts).alias("_pts"), F.col(seq).alias("_pseq"))
    j = increment.join(st, key, "left")
    late = (F.col("_pts").isNotNull() &
            ((F.col(ts) < F.col("_pts")) | ((F.col(ts) == F.col("_pts")) & (F.col(seq) <= F.col("_pseq")))))
    cols = increment.columns
    ok = j.where(~late).select(*cols, "_pb")
    hist = wallet_history(ok, key=key, ts=ts, amount=amount, seq=seq, **scan_opts)
    carried = F.when(F.col("_pb").isNull(), F.col("balance")).otherwise(
        F.coalesce(F.col("balance"), F.lit(0)) + F.col("_pb"))
    hist = hist.withColumn("balance", carried.cast(MONEY)).drop("_pb")
    return hist, j.where(late).select(*cols)


def latest_snapshot(history: DataFrame, day, key: str = "user_id", ts: str = "ts",
                    seq: str = "seq") -> DataFrame:
    """Newest history row per user strictly before ``day`` midnight.

    With ``nxt`` (the next movement, see ``wallet_history(with_next=True)``)
    this is a narrow filter, ``ts < d <= nxt``: no shuffle at all. Without it,
    a max over a struct per user, an aggregate with map-side partial
    aggregation, so a hot user is reduced before the shuffle.
    """
    d = F.lit(day).cast("date") if not hasattr(day, "alias") else day
    if "nxt" in history.columns:
        start = d.cast("timestamp_ntz")
        valid = history.where(before_day_start(ts, d) &
                              (F.col("nxt").isNull() | (F.col("nxt") >= start)))
        return valid.select(key, F.col("balance").alias("balance_at_start_of_day"),
                            F.col(ts).alias("last_movement_timestamp"))
    newest = (history.where(before_day_start(ts, d))
              .groupBy(key)
              .agg(F.max(F.struct(F.col(ts), F.col(seq), F.col("balance"))).alias("_s")))
    return newest.select(key, F.col("_s.balance").alias("balance_at_start_of_day"),
                         F.col(f"_s.{ts}").alias("last_movement_timestamp"))


def validity_intervals(history: DataFrame, key: str = "user_id", ts: str = "ts",
                       seq: str = "seq", **scan_opts) -> DataFrame:
    """``[ts, valid_to)`` per balance row; ``valid_to`` NULL for the newest."""
    if "nxt" in history.columns:
        return history.withColumnRenamed("nxt", "valid_to")
    out = keyed_scan(history, [key], [ts, seq], {}, {"valid_to": F.col(ts)}, **scan_opts)
    return out


def period_bounds(history: DataFrame, ts: str = "ts") -> DataFrame:
    """One row ``(min_date, max_date)``; both NULL when the history is empty."""
    return history.agg(F.min(F.to_date(ts)).alias("min_date"),
                       F.max(F.to_date(ts)).alias("max_date"))


def validity_days(history: DataFrame, period: DataFrame, key: str = "user_id",
                  ts: str = "ts") -> DataFrame:
    """Range join "row i is the balance at the start of day d" as an equi-form.

    Each row with next movement ``nxt`` is the start-of-day balance for days
    ``date(ts)+1 .. date(nxt)`` (the newest row: up to the period end),
    clipped to the period. ``history`` must carry ``nxt``.
    """
    p = period.select(F.col("start_date").alias("_lo"), F.col("end_date").alias("_hi"))
    h = with_scalars(history, p)
    first = F.greatest(F.date_add(F.to_date(ts), 1), F.col("_lo"))
    last = F.least(F.coalesce(F.to_date("nxt"), F.col("_hi")), F.col("_hi"))
    return (h.withColumn("_f", first).withColumn("_t", last)
            .where(F.col("_f") <= F.col("_t"))
            .withColumn("day", F.explode(F.sequence(F.col("_f"), F.col("_t"))))
            .drop("_f", "_t", "_lo", "_hi"))


def monotonic_timestamps(df: DataFrame, ts: str, order: list[str], by: list[str] | None = None,
                         step_seconds: int = 1, **scan_opts) -> DataFrame:
    """Make ``ts`` strictly increasing by ``step`` in (ts, order) order.

    Sequential rule: ``t' = t if t > prev' else prev' + step``. Closed form
    with r = row number (1-based) in order and u = epoch seconds:
    ``t'_i = step*r_i + max_{j<=i}(u_j - step*r_j)``. Both parts are
    associative scans, fused into one pass of the skew-safe keyed scan
    (``maxoff``); ``by=None`` is one global order, split by range partitions.
    """
    by = list(by or [])
    u = F.unix_micros(F.col(ts).cast("timestamp"))
    step = step_seconds * 1_000_000
    scanned = keyed_scan(df, by, [ts, *order],
                         {"_rn": ("count", F.lit(1)), "_m": ("maxoff", (u, step))}, **scan_opts)
    new_ts = F.timestamp_micros(F.col("_m") + F.lit(step) * F.col("_rn")).cast("timestamp_ntz")
    return scanned.withColumn(ts, new_ts).drop("_rn", "_m")


def sorted_events(cdc: DataFrame, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """CDC in timestamp order with a stable tie-break (range-partitioned sort)."""
    return cdc.orderBy(ts, seq)


__all__ = [
    "parse_cdc", "default_null_ts", "wallet_history", "ledger_state", "extend_history", "latest_snapshot",
    "validity_intervals", "period_bounds", "validity_days", "monotonic_timestamps",
    "sorted_events", "trunc_second",
]
