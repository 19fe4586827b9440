"""Committed tables: late movements and rates, days by reference, ids, compaction."""

import datetime as dt
import os
import random

import pytest

from test_faults import A, AS_OF, B, csv, ledger, payments, rates  # noqa: F401
from walletyield.operators.ledger import validity_intervals
from walletyield.plans.pipeline import PipelineConfig, compact_history, open_tables, pipeline_increment, pipeline_main
from walletyield.plans.store import commit_facts, days_of, merge_periods, read_history, read_intervals, read_payout_days, read_payouts, read_users
from walletyield.sources import sql_query

J = lambda d: dt.date(2024, 1, d)


def config(tmp, feed, rates, out, run, start, end):
    return PipelineConfig(f"{tmp}/{feed}", rates, f"{tmp}/{out}", AS_OF, start=start, end=end, run_id=run)


def files_of(spark, out):
    return {(r.payout_date, r.file): r.run for r in read_payout_days(spark, out, commit_facts(spark, out)).collect()}


@pytest.fixture
def flat(tmp_out):
    """The same rate on every day."""
    os.makedirs(f"{tmp_out}/flat")
    with open(f"{tmp_out}/flat/r.csv", "w") as f:
        f.write("rate_date,annual_rate\n" + "".join(f"2024-01-{d:02},11.5\n" for d in range(1, 13)))
    return f"{tmp_out}/flat"


def test_late_movements_change_the_days_already_paid(spark, tmp_out, flat):
    """The movement of 3 January arrives on the 9th: days 4 to 8 are paid again."""
    early = [("1", "2024-01-01T10:00:00", "1000"), ("2", "2024-01-02T10:00:00", "700"), ("3", "2024-01-02T10:00:00", "90")]
    late = [("1", "2024-01-03T10:00:00", "5000"), ("3", "2024-01-08T10:00:00", "900")]
    csv(f"{tmp_out}/a", early)
    csv(f"{tmp_out}/b", late)
    csv(f"{tmp_out}/all", early + late)
    pipeline_main(spark, config(tmp_out, "all", flat, "full", 1, J(2), J(12)))
    pipeline_increment(spark, config(tmp_out, "a", flat, "inc", 1, J(2), J(8)))
    before, ids = files_of(spark, f"{tmp_out}/inc"), {(r.payout_date, r.user_id): r.payout_id for r in read_payouts(spark, f"{tmp_out}/inc", ids=True).collect()}
    pipeline_increment(spark, config(tmp_out, "b", flat, "inc", 2, J(9), J(12)))
    assert payments(spark, f"{tmp_out}/inc") == payments(spark, f"{tmp_out}/full")
    paid = {(d, u): a for d, u, a in payments(spark, f"{tmp_out}/inc")}
    assert (J(4), 1) not in paid and float(paid[J(5), 1]) > 1.5  # held for less than a day, then 6000
    # days 2 and 3 keep their files, the others of the first run were written anew
    after = files_of(spark, f"{tmp_out}/inc")
    assert {k: v for k, v in after.items() if k[0] <= J(3)} == {k: v for k, v in before.items() if k[0] <= J(3)}
    assert {v for k, v in after.items() if k[0] >= J(4)} == {2}
    # rows that pay the same carry their ids
    now = {(r.payout_date, r.user_id): r.payout_id for r in read_payouts(spark, f"{tmp_out}/inc", ids=True).collect()}
    assert all(now[d, u] == i for (d, u), i in ids.items() if u == 2) and len(set(now.values())) == len(now)
    audit = {r.payout_date: r for r in spark.read.parquet(f"{tmp_out}/inc/run_audit/v=2").collect()}
    assert {J(d) for d in range(4, 13)} <= set(audit) and audit[J(5)].payout_records == 2


def test_any_order_of_arrival(spark, tmp_out, rates):
    rnd = random.Random(11)
    rows = [(str(rnd.randint(1, 9)), f"2024-01-{rnd.randint(1, 11):02}T{rnd.randint(0, 23):02}:00:00", str(rnd.randint(-300, 900)))
            for _ in range(80)]
    csv(f"{tmp_out}/all", rows)
    pipeline_main(spark, config(tmp_out, "all", rates, "full", 1, J(2), J(12)))
    rnd.shuffle(rows)
    cut, spans = [0, 30, 55, 80], [(J(2), J(6)), (J(7), J(9)), (J(10), J(12))]
    for i, (a, b) in enumerate(zip(cut, cut[1:]), 1):
        csv(f"{tmp_out}/part{i}", rows[a:b])
        pipeline_increment(spark, config(tmp_out, f"part{i}", rates, "inc", i, *spans[i - 1]))
    assert payments(spark, f"{tmp_out}/inc") == payments(spark, f"{tmp_out}/full")
    assert ledger_sums(spark, f"{tmp_out}/inc") == ledger_sums(spark, f"{tmp_out}/full")


def ledger_sums(spark, out):
    """The balance after each instant (movements of one instant may arrive in another order)."""
    last = {}
    for r in read_history(spark, out).orderBy("user_id", "ts", "seq").collect():
        last[r.user_id, r.ts] = r.balance
    return last


def test_a_corrected_rate_pays_its_days_again(spark, tmp_out, flat):
    csv(f"{tmp_out}/a", [("1", "2024-01-01T10:00:00", "100000")])
    csv(f"{tmp_out}/b", [("2", "2024-01-09T10:00:00", "1000")])
    pipeline_increment(spark, config(tmp_out, "a", flat, "inc", 1, J(2), J(9)))
    first = files_of(spark, f"{tmp_out}/inc")
    with open(f"{flat}/z.csv", "w") as f:
        f.write("rate_date,annual_rate\n2024-01-09,99.0\n")
    pipeline_increment(spark, config(tmp_out, "b", flat, "inc", 2, J(10), J(12)))
    paid = {d: float(a) for d, u, a in payments(spark, f"{tmp_out}/inc") if u == 1}
    assert paid[J(9)] > 3 * paid[J(8)]
    assert all(files_of(spark, f"{tmp_out}/inc")[k] == v for k, v in first.items() if k[0] < J(9))


@pytest.fixture
def three_runs(spark, tmp_out, rates):  # noqa: F811
    csv(f"{tmp_out}/a", A)
    csv(f"{tmp_out}/b", B)
    csv(f"{tmp_out}/c", [("1", "2024-01-08T00:00:00", "40"), ("9", "2024-01-02T00:00:00", "400"), ("2", "2024-01-01T00:00:00", "1")])
    pipeline_main(spark, config(tmp_out, "a", rates, "t", 1, J(2), J(6)))
    pipeline_increment(spark, config(tmp_out, "b", rates, "t", 2, J(7), J(8)))
    pipeline_increment(spark, config(tmp_out, "c", rates, "t", 3, J(9), J(12)))
    return f"{tmp_out}/t"


def test_stored_ends_of_validity(spark, three_runs):
    own = sorted((r.user_id, r.ts, r.seq, r.nxt) for r in read_intervals(spark, three_runs).collect())
    scanned = validity_intervals(read_history(spark, three_runs))
    assert own == sorted((r.user_id, r.ts, r.seq, r.valid_to) for r in scanned.collect()) or [x[:3] for x in own] and \
        [(x[0], x[1], x[3]) for x in own] == sorted((r.user_id, r.ts, r.valid_to) for r in scanned.collect())


def test_ids_are_unique_and_stay(spark, three_runs, tmp_out):
    def ids():
        return {(r.user_id, r.ts, r.seq): r.history_id for r in read_history(spark, three_runs, ids=True).collect()}
    before, paid = ids(), sorted(map(tuple, read_payouts(spark, three_runs, ids=True).collect()))
    assert len(set(before.values())) == len(before) and min(before.values()) >= 1
    facts = commit_facts(spark, three_runs)
    assert max(before.values()) < facts["next_history_id"] and max(r[0] for r in paid) < facts["next_payout_id"]
    rows = ledger(spark, three_runs)
    compact_history(spark, three_runs, 4)
    assert commit_facts(spark, three_runs)["history_runs"] == [4]
    assert ids() == before and ledger(spark, three_runs) == rows
    assert sorted(map(tuple, read_payouts(spark, three_runs, ids=True).collect())) == paid
    csv(f"{tmp_out}/d", [("1", "2024-01-11T00:00:00", "4")])
    pipeline_increment(spark, config(tmp_out, "d", f"{tmp_out}/rates", "t", 5, J(12), J(12)))
    after = ids()
    assert {k: after[k] for k in before} == before and len(set(after.values())) == len(after) == len(before) + 1


def test_views_of_the_committed_tables(spark, three_runs):
    tables = open_tables(spark, three_runs)
    assert {t: df.columns[0] for t, df in tables.items()} == {
        "users": "user_id", "wallet_history": "history_id", "daily_interest_rates": "rate_date", "daily_bonus_payouts": "payout_id"}
    got = sql_query(spark, "SELECT count(*) FROM daily_bonus_payouts p JOIN users u USING (user_id) WHERE payout_date >= :day", {"day": "2024-01-09"})
    assert got.first()[0] == sum(d >= J(9) for d, _, _ in payments(spark, three_runs)) > 0
    assert sorted(r.user_id for r in read_users(spark, three_runs).collect()) == [1, 2, 3, 5, 9]


def test_bitmaps_of_days(spark, three_runs):
    from walletyield.operators.bitmaps import day_bitmaps, users_by_day, users_by_month
    from walletyield.operators.ledger import period_bounds
    from walletyield.plans.store import read_bounds, read_day_users
    paid = payments(spark, three_runs)
    bitmaps = read_day_users(spark, three_runs)
    assert {r.payout_date: r.eligible_users for r in users_by_day(bitmaps).collect()} == {
        d: len({u for e, u, _ in paid if e == d}) for d in {d for d, _, _ in paid}}
    assert [tuple(r) for r in users_by_month(bitmaps).collect()] == [(J(1), len({u for _, u, _ in paid}))]
    odd = spark.createDataFrame([(J(1), u) for u in (1, 1, 32768, 32769, 0, -5, None, 10**12)] + [(J(2), 1)], "payout_date date, user_id long")
    twice = day_bitmaps(odd).unionByName(day_bitmaps(odd))
    assert sorted(map(tuple, users_by_day(twice).collect())) == [(J(1), 6), (J(2), 1)]
    assert users_by_day(day_bitmaps(odd.limit(0))).collect() == []
    assert tuple(read_bounds(spark, three_runs).first()) == tuple(period_bounds(read_history(spark, three_runs)).first())


def test_periods():
    assert merge_periods([["2024-01-02", "2024-01-04"]], J(5), J(6)) == [["2024-01-02", "2024-01-06"]]
    assert merge_periods([["2024-01-08", "2024-01-09"], ["2024-01-02", "2024-01-04"]], J(6), J(6)) == [
        ["2024-01-02", "2024-01-04"], ["2024-01-06", "2024-01-06"], ["2024-01-08", "2024-01-09"]]
    assert days_of([["2024-01-02", "2024-01-03"], ["2024-01-05", "2024-01-05"]]) == [J(2), J(3), J(5)]


def test_empty_feed(spark, tmp_out, rates):  # noqa: F811
    os.makedirs(f"{tmp_out}/none")
    with open(f"{tmp_out}/none/x.csv", "w") as f:
        f.write("user_id,timestamp,amount_change\n")
    pipeline_main(spark, config(tmp_out, "none", rates, "e", 1, J(2), J(3)))
    assert payments(spark, f"{tmp_out}/e") == [] and ledger(spark, f"{tmp_out}/e") == []
    csv(f"{tmp_out}/a", [("1", "2024-01-01T10:00:00", "1000")])
    pipeline_increment(spark, config(tmp_out, "a", rates, "e", 2, J(4), J(4)))
    assert [d for d, _, _ in payments(spark, f"{tmp_out}/e")] == [J(3), J(4)]
