"""Streaming = batch on the same rows; replays and late rows handled."""

import datetime as dt
from decimal import Decimal

from helpers import F

from walletyield.operators.ledger import wallet_history
from walletyield.plans import fixtures as X
from walletyield.streaming import cdc as S

SF = "/root/testdata/sf0.001"


def test_balance_upsert_multi_batch_and_late(spark, tmp_out):
    c = X.cdc(spark, SF)
    src = f"{tmp_out}/in"
    S.write_in_time_slices(c, src, slices=3)
    out, state, late = f"{tmp_out}/h", f"{tmp_out}/s", f"{tmp_out}/late"
    S.run_available_now(S.read_cdc_stream(spark, src, max_files_per_trigger=2), f"{tmp_out}/ck",
                        foreach_batch=lambda df, i: S.balance_upsert_batch(df, i, state, out, late))
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("seq", "user_id", "ts", "amount_change",
                                                                  "balance").collect())
    want = sorted(tuple(r) for r in wallet_history(c).select("seq", "user_id", "ts", "amount_change",
                                                              "balance").collect())
    assert got == want
    # a late row for an existing user is quarantined, not applied
    u = got[0][1]
    spark.createDataFrame([(10**9, u, dt.datetime(2023, 1, 1), Decimal("5.00"))], X.cdc(spark, SF).schema) \
        .write.mode("append").parquet(src)
    S.run_available_now(S.read_cdc_stream(spark, src), f"{tmp_out}/ck",
                        foreach_batch=lambda df, i: S.balance_upsert_batch(df, i, state, out, late))
    assert spark.read.parquet(late).count() == 1


def test_balance_upsert_out_of_order_and_replays(spark, tmp_out):
    def row(seq, user, day, amount):
        return seq, user, dt.datetime(2024, 1, day), Decimal(amount)

    schema = X.cdc(spark, SF).schema
    batches = [[row(1, 7, 5, "10.00"), row(2, 8, 5, "1.00"), row(3, 7, 9, "5.00")],
               [row(4, 7, 2, "100.00"), row(5, 8, 6, "2.00"), row(6, 9, 1, "3.00")],  # 4 is late
               [row(7, 7, 10, "1.00"), row(3, 7, 9, "5.00")],  # 3 comes again
               [row(8, 8, 1, "50.00"), row(9, 7, 5, "7.00")]]  # both are late
    out, state, late = f"{tmp_out}/h", f"{tmp_out}/s", f"{tmp_out}/late"

    def check(rows):
        got = sorted(tuple(r) for r in S.read_balances(spark, state, out, late).collect())
        want = wallet_history(spark.createDataFrame(rows, schema)).select("seq", "user_id", "ts", "amount_change", "balance")
        assert got == sorted(tuple(r) for r in want.collect())

    seen = {}
    for i, rows in enumerate(batches):
        seen |= {r[0]: r for r in rows}
        for _ in range(1 + i % 2):  # a replayed batch changes nothing
            S.balance_upsert_batch(spark.createDataFrame(rows, schema), i, state, out, late)
        if i % 2:
            check(list(seen.values()))


def test_dedup_within_watermark(spark, tmp_out):
    c = X.cdc(spark, SF)
    c.unionByName(c.where(F.col("seq") % 10 == 0)).repartitionByRange(4, "ts").write.parquet(f"{tmp_out}/in")
    stream = S.stream_cdc_dedup(S.read_cdc_stream(spark, f"{tmp_out}/in"), watermark="2 days")
    S.run_available_now(stream, f"{tmp_out}/ck", sink_path=f"{tmp_out}/out")
    assert spark.read.parquet(f"{tmp_out}/out").count() == c.count()
