"""Invariants: loop = set form, skew split = plain, closed forms = loops."""

import datetime as dt

from helpers import F, cdc_frame

from walletyield.operators.asof import asof_join
from walletyield.operators.ledger import monotonic_timestamps, wallet_history
from walletyield.operators.scan import keyed_scan
from walletyield.operators.sinks import assign_surrogate_key
from walletyield.plans import fixtures as X
from walletyield.plans.payouts import calendar, payouts_day

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_period_equals_each_day(spark):
    h = X.history(spark, SF)
    rates = X.rates(spark, SF)
    days = [r.payout_date for r in calendar(X.period(spark, SF)).collect()]
    per_day = []
    for d in days:
        per_day += [tuple(r) for r in payouts_day(h, rates, d).collect()]
    assert sorted(per_day) == rows(X.payouts(spark, SF))


def test_hot_key_split_equals_plain(spark):
    c = X.cdc(spark, SF)
    plain = wallet_history(c, with_next=True, split_hot=False)
    # every key is "hot" at this fanout: all rows go through the range-split path
    split = wallet_history(c, with_next=True, fanout=10_000, range_partitions=5)
    assert rows(plain) == rows(split)


def test_one_hot_user_split(spark):
    # one user with most rows, others small: both paths in one plan
    data = [(i, 1, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", 1.0) for i in range(300)]
    data += [(1000 + i, 2 + i % 3, f"2024-01-02 00:00:{i:02d}", 2.0) for i in range(30)]
    c = cdc_frame(spark, data)
    plain = wallet_history(c, with_next=True, split_hot=False)
    split = wallet_history(c, with_next=True, fanout=4, range_partitions=6)
    assert rows(plain) == rows(split)


def test_global_scan_matches_window(spark):
    from pyspark.sql import Window
    c = X.cdc(spark, SF)
    g = keyed_scan(c, [], ["ts", "seq"], {"n": ("count", F.lit(1)), "mx": ("max", F.col("amount_change"))},
                   {"nx": F.col("seq")}, range_partitions=4)
    w = Window.orderBy("ts", "seq")
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    ref = c.select("*", F.count(F.lit(1)).over(wr).alias("n"), F.max("amount_change").over(wr).alias("mx"),
                   F.lead("seq").over(w).alias("nx"))
    assert rows(g.select(*ref.columns)) == rows(ref)


def test_monotonic_equals_loop(spark):
    base = dt.datetime(2024, 1, 1)
    ts = [0, 0, 0, 1, 5, 5, 2, 10, 10, 10, 10, 11]
    data = [(i, 1, str(base + dt.timedelta(seconds=s)), 1) for i, s in enumerate(ts)]
    c = cdc_frame(spark, data)
    got = [r.ts for r in monotonic_timestamps(c.select("seq", "ts"), "ts", ["seq"], range_partitions=3)
           .orderBy("ts").collect()]
    prev, want = None, []
    for s in sorted((b, i) for i, b in enumerate(ts)):
        t = base + dt.timedelta(seconds=s[0])
        if prev is not None and t <= prev:
            t = prev + dt.timedelta(seconds=1)
        want.append(t)
        prev = t
    assert got == want


def test_surrogate_key_dense_unique(spark):
    p = X.payouts(spark, SF)
    k = assign_surrogate_key(p, ["payout_date", "user_id"], 101, "payout_id", range_partitions=3)
    ids = sorted(r.payout_id for r in k.collect())
    assert ids == list(range(101, 101 + p.count()))


def test_asof_strict_vs_inclusive(spark):
    left = spark.createDataFrame([(1, dt.datetime(2024, 1, 2))], "user_id long, t timestamp_ntz")
    right = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 10), (1, dt.datetime(2024, 1, 2), 20)],
                                  "user_id long, ts timestamp_ntz, v int")
    s = asof_join(left, right, ["user_id"], "t", "ts", strict=True, right_cols=["v"]).collect()[0]
    i = asof_join(left, right, ["user_id"], "t", "ts", strict=False, right_cols=["v"]).collect()[0]
    assert (s.v, i.v) == (10, 20)
    tol = asof_join(left, right, ["user_id"], "t", "ts", strict=True, right_cols=["ts", "v"],
                    tolerance=F.expr("INTERVAL 12 HOURS")).collect()[0]
    assert tol.v is None


def test_shuffled_input_same_result(spark):
    c = X.cdc(spark, SF)
    a = wallet_history(c)
    b = wallet_history(c.repartition(7).orderBy(F.rand(3)))
    assert rows(a) == rows(b)


def test_monotonic_by_user_split_equals_plain(spark):
    c = X.cdc_skewed(spark, SF).select("seq", "user_id", "ts")
    plain = monotonic_timestamps(c, "ts", ["seq"], by=["user_id"], split_hot=False)
    split = monotonic_timestamps(c, "ts", ["seq"], by=["user_id"], fanout=8, range_partitions=4)
    assert rows(plain) == rows(split)


def test_payouts_since_equals_full_period(spark):
    import datetime as dt

    from walletyield.plans.payouts import one_row_period, payouts_period, payouts_since
    h = X.history(spark, SF, with_next=True)
    rates = X.rates(spark, SF)
    for lo, hi in [(dt.date(2024, 1, 2), dt.date(2024, 1, 30)), (dt.date(2024, 1, 17), dt.date(2024, 1, 17)),
                   (dt.date(2023, 12, 1), dt.date(2024, 1, 5))]:
        full = payouts_period(h, rates, one_row_period(spark, lo, hi))
        part = payouts_since(h.drop("nxt"), rates, lo, hi)
        assert rows(full) == rows(part), (lo, hi)


def test_extend_history_equals_full_and_flags_late(spark):
    import datetime as dt

    from walletyield.operators.ledger import extend_history, ledger_state
    c = X.cdc_skewed(spark, SF)
    cut = F.lit(dt.datetime(2024, 1, 12)).cast("timestamp_ntz")
    full = wallet_history(c)
    state = ledger_state(wallet_history(c.where(F.col("ts") < cut)))
    late_row = c.where(F.col("ts") < cut).limit(1).withColumn("seq", F.lit(-1).cast("long"))
    inc = c.where(F.col("ts") >= cut).unionByName(late_row)
    hist, late = extend_history(state, inc, fanout=8, range_partitions=3)
    assert rows(hist) == rows(full.where(F.col("ts") >= cut))
    assert late.count() == 1
