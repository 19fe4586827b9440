"""Boundary rows the reference leaves untested (FIXTURES.md part 3).

Every case is checked on both forms: one day at a time and the set-based
period plan, which must agree.
"""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import cdc_frame, period_frame, rates_frame

from walletyield.operators.ledger import wallet_history
from walletyield.operators.rates import reject_bad_rates
from walletyield.operators.sinks import replace_days
from walletyield.plans.payouts import (payouts_day, payouts_period, processed_days,
                                       publishable_days, resolve_period, run_audit)

DAY = dt.date(2024, 5, 15)
RATE = [("2024-05-15", "0.001")]


def paid(spark, rows, rates=RATE, day=DAY):
    cdc = cdc_frame(spark, rows)
    rt = rates_frame(spark, rates)
    per_day = {(r.user_id, r.calculated_amount) for r in payouts_day(wallet_history(cdc), rt, day).collect()}
    h = wallet_history(cdc, with_next=True)
    # the snapshot as a filter on the validity interval (history with ``nxt``)
    per_day_filter = {(r.user_id, r.calculated_amount) for r in payouts_day(h, rt, day).collect()}
    assert per_day == per_day_filter
    per = {(r.user_id, r.calculated_amount)
           for r in payouts_period(h, rt, period_frame(spark, str(day), str(day))).collect()}
    assert per_day == per
    return per


def test_min_balance_is_strict(spark):
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 100.00), (2, 2, "2024-05-10 10:00:00", 100.01)])
    assert {u for u, _ in got} == {2}


@pytest.mark.parametrize("ts,ok", [("2024-05-14 00:00:00", True), ("2024-05-14 00:00:00.900000", True),
                                   ("2024-05-14 00:00:01", False)])
def test_hold_whole_seconds(spark, ts, ok):
    got = paid(spark, [(1, 1, ts, 500)])
    assert bool(got) is ok


def test_move_at_midnight_belongs_to_the_day(spark):
    # the 00:00:00 move is not before the day: the older balance stays the snapshot
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 1000), (2, 1, "2024-05-15 00:00:00", -950)])
    assert got == {(1, Decimal("1.00"))}


def test_ties_higher_seq_wins(spark):
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 1000), (2, 1, "2024-05-10 10:00:00", -900)])
    assert got == set()  # balance after seq 2 is 100: not paid
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 1000), (2, 1, "2024-05-10 10:00:00", 50)])
    assert got == {(1, Decimal("1.05"))}  # seq 2's balance (1050), not seq 1's (1000)


@pytest.mark.parametrize("rate_day,ok", [("2024-02-16", True), ("2024-02-15", False)])
def test_lookback_89_days(spark, rate_day, ok):
    # 2024-05-15 - 89 days = 2024-02-16
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 1000)], rates=[(rate_day, "0.001")])
    assert bool(got) is ok


def test_null_amount_keeps_balance_restarts_hold(spark):
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 1000), (2, 1, "2024-05-14 12:00:00", None)])
    assert got == set()
    h = wallet_history(cdc_frame(spark, [(1, 1, "2024-05-10 10:00:00", 1000),
                                         (2, 1, "2024-05-14 12:00:00", None)]))
    assert [r.balance for r in h.orderBy("seq").collect()] == [1000, 1000]


def test_rounding_half_up(spark):
    # 500.50 * 0.00100000 = 0.5005 -> 0.50 ; 1005.00 * 0.001 = 1.005 -> 1.01
    got = paid(spark, [(1, 1, "2024-05-10 10:00:00", 1005.00)])
    assert got == {(1, Decimal("1.01"))}


def test_bad_rates_rejected(spark):
    raw = spark.createDataFrame([(dt.date(2024, 1, d), t) for d, t in
                                 [(1, "NaN"), (2, "abc"), (3, "-101"), (4, "13.65"), (5, None)]],
                                "rate_date date, annual_rate string")
    good, bad = reject_bad_rates(raw)
    assert [r.rate_date.day for r in good.collect()] == [4]
    assert sorted(r.rate_date.day for r in bad.collect()) == [1, 2, 3, 5]


def test_period_rules(spark):
    b = spark.range(1).selectExpr("date'2024-05-01' as min_date", "date'2024-05-20' as max_date")
    with pytest.raises(ValueError):
        resolve_period(b, DAY, dt.date(2024, 5, 10), dt.date(2024, 5, 1))
    with pytest.raises(ValueError):
        resolve_period(b, DAY, dt.date(2024, 5, 10), None)
    p = resolve_period(b, DAY).collect()[0]
    assert (p.start_date, p.end_date) == (dt.date(2024, 5, 2), dt.date(2024, 5, 14))
    empty = spark.range(1).selectExpr("cast(null as date) as min_date", "cast(null as date) as max_date")
    from walletyield.plans.payouts import calendar
    assert calendar(resolve_period(empty, DAY)).count() == 0


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_republish_rules(spark):
    old = spark.createDataFrame([(dt.date(2024, 5, 15), 1, Decimal("9.99")), (dt.date(2024, 5, 16), 1, Decimal("9.99"))],
                                "payout_date date, user_id long, calculated_amount decimal(18,2)")
    # nobody eligible now; rate only for the 15th (the 16th can't see one: look-back ends)
    cdc = cdc_frame(spark, [(1, 1, "2024-05-10 10:00:00", 50)])
    h = wallet_history(cdc, with_next=True)
    rates = rates_frame(spark, [("2024-05-15", "0.001")])
    period = period_frame(spark, "2024-05-15", "2024-05-16")
    new = payouts_period(h, rates, period)
    audit = run_audit(h, rates, new, period)
    st = {r.payout_date.day: r.status for r in audit.collect()}
    assert st[15] == "NONE_ELIGIBLE"
    out = replace_days(old, new, processed_days(audit))
    assert rows_of(publishable_days(h, rates, period)) == rows_of(processed_days(audit))
    days = sorted(r.payout_date.day for r in out.collect())
    assert 15 not in days  # day emptied
    # republish twice = once
    out2 = replace_days(out, new, processed_days(audit))
    assert sorted(map(tuple, out2.collect())) == sorted(map(tuple, out.collect()))


def test_republish_keeps_day_without_rate(spark):
    old = spark.createDataFrame([(dt.date(2024, 5, 15), 1, Decimal("9.99"))],
                                "payout_date date, user_id long, calculated_amount decimal(18,2)")
    cdc = cdc_frame(spark, [(1, 1, "2024-05-10 10:00:00", 5000)])
    h = wallet_history(cdc, with_next=True)
    rates = rates_frame(spark, [("2023-01-01", "0.001")])  # far too old
    period = period_frame(spark, "2024-05-15", "2024-05-15")
    new = payouts_period(h, rates, period)
    audit = run_audit(h, rates, new, period)
    assert audit.collect()[0].status == "NO_RATE"
    assert publishable_days(h, rates, period).count() == 0
    out = replace_days(old, new, processed_days(audit))
    assert [tuple(r) for r in out.collect()] == [(dt.date(2024, 5, 15), 1, Decimal("9.99"))]


def test_log_steps_missing_and_out_of_order(spark):
    from walletyield.operators.logs import log_parse, step_timings
    lines = spark.createDataFrame([
        ("2024-01-01 10:00:05,000 [INFO] src.main: Step B...",),
        ("2024-01-01 10:00:00,000 [INFO] src.main: Step C...",),
        ("2024-01-01 10:00:09,500 [ERROR] src.main: done",),
        ("  continuation",)], "value string")
    parsed, unparsed = log_parse(lines)
    assert unparsed.count() == 1
    t = step_timings(parsed, ["Step A...", "Step B...", "Step C..."]).orderBy("step_no").collect()
    assert [r.step for r in t] == ["Step B...", "Step C..."]
    assert t[0].duration_s == -5.0 and t[1].duration_s == 9.5
