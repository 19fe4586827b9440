"""The reference's own unit tests, re-expressed on our operators."""

import datetime as dt
import decimal
from decimal import Decimal

from helpers import F, cdc_frame, period_frame, rates_frame

from walletyield.functions import exact_daily_rate
from walletyield.operators.ledger import parse_cdc, period_bounds, wallet_history
from walletyield.operators.rates import annual_to_daily_rate, load_rates, upsert_rates
from walletyield.plans.payouts import payouts_day, payouts_period


def test_running_balance_two_users(spark):
    raw = spark.createDataFrame(
        [(1, 1, "2024-05-01T10:00:00", Decimal("100")), (2, 1, "2024-05-03T10:00:00", Decimal("-20")),
         (3, 1, "2024-05-04T10:00:00", Decimal("30")), (4, 2, "2024-05-02T10:00:00", Decimal("50"))],
        "seq long, user_id long, ts string, amount_change decimal(18,2)")
    cdc, _ = parse_cdc(raw, dt.datetime(2024, 6, 1))
    out = wallet_history(cdc).orderBy("user_id", "ts").collect()
    assert [r.balance for r in out if r.user_id == 1] == [100, 80, 110]
    assert [r.balance for r in out if r.user_id == 2] == [50]
    assert "amount_change" in wallet_history(cdc).columns


def test_null_timestamp_row_kept(spark):
    raw = spark.createDataFrame([(1, 1, None, Decimal("50"))],
                                "seq long, user_id long, ts timestamp, amount_change decimal(18,2)")
    cdc, _ = parse_cdc(raw, dt.datetime(2024, 6, 1, 12))
    rows = wallet_history(cdc).collect()
    assert rows and rows[0].balance == 50
    assert rows[0].ts == dt.datetime(2024, 6, 1, 12)


def test_rate_of_a_day(spark):
    a = spark.createDataFrame([(dt.date(2022, 1, 1), 13.65)], "rate_date date, annual_rate double")
    r = annual_to_daily_rate(a).collect()[0]
    annual = decimal.Decimal("13.65")
    with decimal.localcontext() as ctx:
        ctx.prec = 28
        exact = (1 + annual / 100) ** (decimal.Decimal(1) / decimal.Decimal(365)) - 1
    ten = a.select(exact_daily_rate("annual_rate").alias("r")).collect()[0].r
    assert abs(ten - exact) < Decimal("1e-10")
    assert abs(r.daily_rate - exact) < Decimal("1e-8")
    assert r.daily_rate == Decimal("0.00035062")


def test_source_failure_gives_nothing_new(spark):
    current = rates_frame(spark, [("2022-01-01", "0.001")])
    raw = spark.createDataFrame([], "rate_date date, annual_rate string")
    bounds = spark.range(1).selectExpr("date'2022-01-01' as min_date", "date'2022-01-02' as max_date")
    table, bad = load_rates(raw, bounds, current, dt.date(2030, 1, 1))
    assert table.count() == 1 and bad.count() == 0


def test_no_history_loads_nothing(spark):
    empty = cdc_frame(spark, [])
    bounds = period_bounds(empty)
    assert bounds.collect()[0] == (None, None)
    raw = spark.createDataFrame([(dt.date(2022, 1, 1), "13.65")], "rate_date date, annual_rate string")
    current = rates_frame(spark, [])
    table, _ = load_rates(raw, bounds, current, dt.date(2030, 1, 1))
    assert table.count() == 0


def test_rate_upsert_two_rows(spark):
    cur = rates_frame(spark, [("2022-01-01", "0.009")])
    inc = rates_frame(spark, [("2022-01-01", "0.001"), ("2022-01-02", "0.002")])
    out = {r.rate_date: r.daily_rate for r in upsert_rates(cur, inc).collect()}
    assert out == {dt.date(2022, 1, 1): Decimal("0.00100000"), dt.date(2022, 1, 2): Decimal("0.00200000")}


def test_payouts_of_2024_05_15(spark):
    hist = spark.createDataFrame(
        [(1, 1, dt.datetime(2024, 5, 10, 10), Decimal("2000.00")),
         (2, 2, dt.datetime(2024, 5, 10, 11), Decimal("50.00")),
         (3, 3, dt.datetime(2024, 5, 14, 8), Decimal("500.00")),
         (4, 4, dt.datetime(2024, 5, 13, 23, 59, 59), Decimal("300.00"))],
        "seq long, user_id long, ts timestamp_ntz, balance decimal(18,2)")
    rates = rates_frame(spark, [("2024-05-15", "0.00042")])
    day = dt.date(2024, 5, 15)
    got = sorted((r.user_id, r.calculated_amount) for r in payouts_day(hist, rates, day).collect())
    assert got == [(1, Decimal("0.84")), (4, Decimal("0.13"))]
    # the set-based form gives the same for that day
    h2 = hist.withColumn("nxt", F.lit(None).cast("timestamp_ntz"))
    got2 = sorted((r.user_id, r.calculated_amount)
                  for r in payouts_period(h2, rates, period_frame(spark, "2024-05-15", "2024-05-15")).collect())
    assert got2 == got
