"""Streaming queries, each checked against the batch result on the same rows.

The stream input is the CDC fixture written once as parquet files under the
shared checkpoint folder; each run uses a fresh directory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from walletyield.plans import fixtures as X
from walletyield.plans.catalog import register
from walletyield.session import scratch_path
from walletyield.streaming import cdc as S


def _run_dir(spark, tag):
    return scratch_path(spark, f"stream-{tag}-{uuid.uuid4().hex[:8]}")


def _write_input(spark, sf, base, with_replays=False):
    c = X.cdc(spark, sf)
    if with_replays:
        c = c.unionByName(c.where(F.col("seq") % 20 == 0))
    S.write_in_time_slices(c, f"{base}/in", slices=4)
    return f"{base}/in"


@register("stream_cdc_dedup", "SELECT seq, user_id, ts, amount_change FROM cdc")
def q_stream_cdc_dedup(spark, sf):
    base = _run_dir(spark, "dedup")
    src = _write_input(spark, sf, base, with_replays=True)
    stream = S.stream_cdc_dedup(S.read_cdc_stream(spark, src), watermark="2 days")
    S.run_available_now(stream, f"{base}/ckpt", sink_path=f"{base}/out",
                        state_partitions=spark.sparkContext.defaultParallelism)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@register("stream_daily_movements", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, COUNT(*) AS movements,
       CAST(SUM(amount_change) AS DECIMAL(18,2)) AS net_change
FROM cdc GROUP BY 1""")
def q_stream_daily_movements(spark, sf):
    base = _run_dir(spark, "daily")
    src = _write_input(spark, sf, base)
    agg = S.stream_daily_movements(S.read_cdc_stream(spark, src, max_files_per_trigger=8), watermark="2 days")
    table = f"{base}/table"
    S.run_available_now(agg, f"{base}/ckpt", output_mode="update",
                        foreach_batch=lambda df, i: S.window_upsert_batch(df, i, table),
                        state_partitions=spark.sparkContext.defaultParallelism)
    return S.latest(spark, table)


@register("stream_balance_upsert", """
SELECT seq, user_id, ts, amount_change, balance FROM history""")
def q_stream_balance_upsert(spark, sf):
    # every tenth movement arrives after all others, out of time order
    base = _run_dir(spark, "balance")
    c, src = X.cdc(spark, sf), f"{base}/in"
    out, state, late = f"{base}/history", f"{base}/state", f"{base}/late"
    for part, slices in ((c.where(F.col("seq") % 10 != 0), 4), (c.where(F.col("seq") % 10 == 0), 1)):
        S.write_in_time_slices(part, src, slices)
        S.run_available_now(S.read_cdc_stream(spark, src, max_files_per_trigger=8), f"{base}/ckpt",
                            foreach_batch=lambda df, i: S.balance_upsert_batch(df, i, state, out, late))
    return S.read_balances(spark, state, out, late)


@register("stream_daily_movements_late", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, COUNT(*) AS movements,
       CAST(SUM(amount_change) AS DECIMAL(18,2)) AS net_change
FROM cdc GROUP BY 1""")
def q_stream_daily_movements_late(spark, sf):
    """Every tenth movement arrives weeks behind all others, far past any watermark."""
    base = _run_dir(spark, "daily-late")
    c, src, table = X.cdc(spark, sf), f"{base}/in", f"{base}/table"
    for part, slices in ((c.where(F.col("seq") % 10 != 0), 4), (c.where(F.col("seq") % 10 == 0), 1)):
        S.write_in_time_slices(part, src, slices)
        S.run_available_now(S.read_cdc_stream(spark, src, max_files_per_trigger=8), f"{base}/ckpt",
                            foreach_batch=lambda df, i: S.daily_movements_batch(df, i, table))
    return S.read_daily_movements(spark, table)
