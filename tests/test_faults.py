"""Feeds with ties, empty cells, late rows, replays and crashes."""

import datetime as dt
import shutil
from decimal import Decimal

import pytest
from helpers import cdc_frame, rates_frame

from pyspark.sql import functions as F
from walletyield.operators.asof import asof_join
from walletyield.operators.ledger import ledger_state
from walletyield.operators.rates import upsert_rates
from walletyield.plans import pipeline
from walletyield.plans.payouts import payouts_day
from walletyield.plans.pipeline import PipelineConfig, pipeline_increment, pipeline_main, read_history, read_payouts

AS_OF = dt.date(2024, 2, 1)
DAYS = {"start": dt.date(2024, 1, 2), "end": dt.date(2024, 1, 12)}


def csv(path, rows):
    import os
    os.makedirs(path, exist_ok=True)
    for i in range(0, len(rows), 4):  # several files
        with open(f"{path}/part-{i:04}.csv", "w") as f:
            f.write("user_id,timestamp,amount_change\n" + "".join(",".join(r) + "\n" for r in rows[i : i + 4]))


@pytest.fixture
def rates(tmp_out):
    path = f"{tmp_out}/rates"
    import os
    os.makedirs(path)
    with open(f"{path}/r.csv", "w") as f:
        f.write("rate_date,annual_rate\n" + "".join(f"2024-01-{d:02},11.5\n" for d in range(1, 13)) + "2024-01-05,oops\n2024-01-03,12.5\n")
    return path


def rows_of(df):
    return sorted((r.user_id, r.ts, r.balance) for r in df.select("user_id", "ts", "balance").collect())


def payments(spark, out):
    return sorted((r.payout_date, r.user_id, r.calculated_amount) for r in read_payouts(spark, out).collect())


def ledger(spark, out):
    return rows_of(read_history(spark, out))


A = [("1", "2024-01-01T10:00:00", "5000"), ("1", "2024-01-01T10:00:00", "-1000"), ("1", "2024-01-01T10:00:00", "-1000"),
     ("2", "2024-01-01T09:00:00", ""), ("2", "2024-01-02T09:00:00", "300"), ("", "2024-01-02T09:00:00", "7"),
     ("3", "2024-01-03T00:00:00", "250"), ("3", "2024-01-04T00:00:00", "0"), ("4", "2024-01-02T00:00:00", "x")]
B = [("1", "2024-01-01T10:00:00", "10"), ("3", "2024-01-05T00:00:00", "11"), ("3", "2024-01-03T12:00:00", "500"),
     ("2", "2024-01-06T00:00:00", "1"), ("5", "2024-01-06T00:00:00", "900"), ("3", "2024-01-05T00:00:00", "-12")]


def test_ties_and_empty_cells_full_then_increment(spark, tmp_out, rates):
    csv(f"{tmp_out}/a", A)
    csv(f"{tmp_out}/b", B)
    csv(f"{tmp_out}/all", A[:8] + A[8:] + B)
    one, two = f"{tmp_out}/one", f"{tmp_out}/two"
    full = pipeline_main(spark, PipelineConfig(f"{tmp_out}/all", rates, one, AS_OF, run_id=1, **DAYS))
    pipeline_main(spark, PipelineConfig(f"{tmp_out}/a", rates, two, AS_OF, run_id=1, **DAYS))
    first = read_history(spark, two)
    assert [r.balance for r in first.where("user_id = 1").orderBy("seq").collect()] == [5000, 4000, 3000]
    assert ledger_state(first).where("user_id = 1").first().balance == 3000
    reasons = {r.reason for r in spark.read.parquet(f"{two}/quarantine/v=1").collect()}
    assert reasons == {"malformed row", "no user"}
    assert spark.read.parquet(f"{two}/cdc_report/v=1").count() == 2
    assert spark.read.parquet(f"{two}/rejected_rates/v=1").count() == 1
    assert {r.rate_date.day: r.daily_rate for r in spark.read.parquet(full["daily_interest_rates"]).collect()}[3] == Decimal(f"{1.125 ** (1 / 365) - 1:.8f}")
    pipeline_increment(spark, PipelineConfig(f"{tmp_out}/b", rates, two, AS_OF, run_id=2, **DAYS))
    assert ledger(spark, two) == ledger(spark, one)
    pay = [payments(spark, out) for out in (one, two)]
    assert pay[0] == pay[1] and pay[0]
    history, daily = read_history(spark, one), spark.read.parquet(full["daily_interest_rates"])
    for d in (3, 8):
        day = payouts_day(history, daily, dt.date(2024, 1, d))
        assert sorted((r.user_id, r.calculated_amount) for r in day.collect()) == sorted(x[1:] for x in pay[0] if x[0].day == d)


def test_a_crash_leaves_nothing_to_a_retry(spark, tmp_out, rates, monkeypatch):
    csv(f"{tmp_out}/a", A)
    csv(f"{tmp_out}/b", B)
    clean, broken = f"{tmp_out}/clean", f"{tmp_out}/broken"
    for out in (clean, broken):
        pipeline_main(spark, PipelineConfig(f"{tmp_out}/a", rates, out, AS_OF, run_id=1, **DAYS))
    pipeline_increment(spark, PipelineConfig(f"{tmp_out}/b", rates, clean, AS_OF, run_id=2, **DAYS))
    write, run = pipeline.publish, 2
    for failing in ("ledger_state", "payout_days"):
        def stop(df, path, *a, **k):
            if path.endswith(failing):
                raise RuntimeError("crash")
            return write(df, path, *a, **k)
        monkeypatch.setattr(pipeline, "publish", stop)
        with pytest.raises(RuntimeError):
            pipeline_increment(spark, PipelineConfig(f"{tmp_out}/b", rates, broken, AS_OF, run_id=run, **DAYS))
        run += 1
    monkeypatch.setattr(pipeline, "publish", write)
    pipeline_increment(spark, PipelineConfig(f"{tmp_out}/b", rates, broken, AS_OF, run_id=run, **DAYS))
    assert ledger(spark, broken) == ledger(spark, clean)
    assert payments(spark, broken) == payments(spark, clean)


def test_replayed_batches(spark, tmp_out):
    from walletyield.streaming.cdc import balance_upsert_batch, latest, read_state, window_upsert_batch
    batches = [cdc_frame(spark, [(1, 1, "2024-01-01 00:00:00", 5), (2, 2, "2024-01-01 00:00:00", 7)]),
               cdc_frame(spark, [(3, 1, "2024-01-02 00:00:00", 10)]), cdc_frame(spark, [(4, 1, "2024-01-03 00:00:00", 1)])]
    args = [f"{tmp_out}/{x}" for x in ("state", "out", "late")]
    for i in (0, 1, 1, 2, 2):
        balance_upsert_batch(batches[i], i, *args)
    assert sorted((r.user_id, r.balance) for r in read_state(spark, args[0]).collect()) == [(1, 16), (2, 7)]
    assert spark.read.parquet(f"{args[0]}/v=2").count() == 1  # the user of the batch, not all users
    assert spark.read.parquet(f"{args[1]}/batch=1").count() == 1 and spark.read.parquet(f"{args[1]}/batch=2").count() == 1
    table = f"{tmp_out}/windows"
    w = [spark.createDataFrame([(dt.datetime(2024, 1, d), n)], "window_start timestamp_ntz, movements long") for d, n in ((1, 4), (2, 5), (2, 6))]
    for i in (0, 1, 1, 2, 2):
        window_upsert_batch(w[i], i, table)
    assert sorted(r.movements for r in latest(spark, table).collect()) == [4, 6]
    shutil.rmtree(table)


def test_logs_of_batches_are_compacted(spark, tmp_out, monkeypatch):
    from walletyield.streaming import cdc
    monkeypatch.setattr(cdc, "COMPACT_AFTER", 2)
    batches = [cdc_frame(spark, [(i, i % 3, f"2024-01-{i + 1:02} 00:00:00", i + 1), (100 + i, 7, f"2024-01-{9 - i:02} 12:00:00", 1)]) for i in range(7)]
    args, days = [f"{tmp_out}/{x}" for x in ("state", "out", "late")], f"{tmp_out}/days"
    for i in (0, 1, 1, 2, 3, 4, 5, 5, 6):
        cdc.balance_upsert_batch(batches[i], i, *args)
        cdc.daily_movements_batch(batches[i], i, days)
    want = {0: 1 + 4 + 7, 1: 2 + 5, 2: 3 + 6, 7: 7}
    assert {r.user_id: r.balance for r in cdc.read_state(spark, args[0]).collect()} == want
    newest = {r.user_id: r.balance for r in ledger_state(cdc.read_balances(spark, *args)).collect()}
    assert newest == want
    got = {(r.window_start.day): (r.movements, int(r.net_change)) for r in cdc.read_daily_movements(spark, days).collect()}
    assert got == {d: ((d <= 7) + (d >= 3), (d if d <= 7 else 0) + (d >= 3)) for d in range(1, 10)}
    import os
    assert len([n for n in os.listdir(days) if not n.startswith("_")]) < 7


def test_asof_join_nulls_and_tolerance(spark):
    left = spark.createDataFrame([(1, 10, "a"), (None, 10, "b"), (1, None, "c"), (1, 50, "d"), (2, 10, "e")], "k int, t int, v string")
    right = spark.createDataFrame([(1, 5, 10), (None, 5, 20), (1, None, 30), (2, 10, 40)], "k int, t2 int, w int")

    def got(**k):
        return {r.v: r.w for r in asof_join(left, right, ["k"], "t", "t2", right_cols=["w"], **k).collect()}

    assert got() == {"a": 10, "b": None, "c": None, "d": 10, "e": None}
    assert got(strict=False, tolerance=F.lit(20)) == {"a": 10, "b": None, "c": None, "d": None, "e": 40}


def test_last_rate_of_a_date_wins(spark):
    cur = rates_frame(spark, [("2024-01-01", "0.1"), ("2024-01-02", "0.2")])
    inc = rates_frame(spark, [("2024-01-02", f"0.{n}") for n in range(3, 9)]).withColumn("o", F.monotonically_increasing_id())
    for order in ("o", None):
        new = upsert_rates(cur, (inc if order else inc.drop("o").coalesce(1)), order)
        assert {r.rate_date.day: float(r.daily_rate) for r in new.collect()} == {1: 0.1, 2: 0.8}
