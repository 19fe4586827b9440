"""The end-to-end batch pipeline: users -> history -> rates -> payouts.

Plain functions over a config object. Tables are kept by reference below ``out_dir``
(:mod:`walletyield.plans.store`): a run parses its files once, writes what it adds, and
names itself in ``_commits`` at the end.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from walletyield.config import DAILY_PAYOUTS, DAILY_RATES, DEFAULT, MONEY, USERS, WALLET_HISTORY, Thresholds
from walletyield.functions import parse_cdc_ts
from walletyield.operators import sinks
from walletyield.operators.bitmaps import day_bitmaps
from walletyield.operators.ledger import default_null_ts, extend_history, ledger_state, wallet_history
from walletyield.operators.rates import load_rates, rate_asof
from walletyield.plans import corrections
from walletyield.plans.payouts import one_row_period, payouts_period, payouts_since, resolve_period, run_audit
from walletyield.plans.store import (PAYOUT_DAYS, STORED_HISTORY, STORED_PAYOUTS, allocate_ids, commit_facts, commit_run, days_of,
                                     merge_periods, read_history, read_intervals, read_payout_days, read_payouts, read_runs,
                                     read_users, read_version, remove)
from walletyield.sources import cdc_csv_rows, read_rate_series, register_views, user_ids_range


@dataclass
class PipelineConfig:
    raw_cdc_path: str
    rates_path: str
    out_dir: str
    as_of: dt.date
    rates_format: str = "csv"
    num_users: int | None = None
    start: dt.date | None = None
    end: dt.date | None = None
    thresholds: Thresholds = field(default_factory=lambda: DEFAULT)
    run_id: int = field(default_factory=lambda: int(time.time() * 1000))


STATE = WALLET_HISTORY  # seq, user_id, ts, amount_change, balance (amount unused in the state)
#: Bits of ``seq`` for a row's place among the rows that a task read before it.
ROW_BITS = 33


def publish(df: DataFrame, path: str, run_id: int, schema) -> str:
    out = f"{path.rstrip('/')}/v={run_id}"
    sinks.write_table(df, out, schema)
    return out


def split_places(spark: SparkSession, raw_path: str) -> tuple[DataFrame, int]:
    """For every file: the number of its first split, in order of the paths; and the split unit.

    Splits begin at multiples of a size that is never below the unit. Only the listing is
    read (one row for each file), not the files.
    """
    def size(conf: str) -> int:
        return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(conf))

    unit = min(size("spark.sql.files.maxPartitionBytes"), size("spark.sql.files.openCostInBytes"))
    files = spark.read.format("binaryFile").load(raw_path).select(
        F.col("_metadata.file_path").alias("_file"), (F.floor(F.col("_metadata.file_size") / unit) + 1).alias("_splits"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("_first", F.coalesce(F.sum("_splits").over(before), F.lit(0))), unit


def sequence_in_files(rows: DataFrame, places: DataFrame, unit: int, start: int = 0) -> DataFrame:
    """``seq`` from ``file_order``: the split's number, then the row's place in its task.

    A task reads the rows of a split in order, so numbers are unique and stand in file
    order however the splits were dealt; the rows themselves are read once and stay put.
    """
    o = F.col("file_order")
    split = F.col("_first") + F.floor(o["block"] / unit)
    seq = F.lit(start) + F.shiftleft(split.cast("long"), ROW_BITS) + o["row"].bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (rows.join(F.broadcast(places.select("_file", "_first")), o["file"] == F.col("_file"))
            .withColumn("seq", seq).drop("_file", "_first", "file_order"))


def parsed_cdc(spark: SparkSession, raw_path: str, as_of: dt.date, start: int = 0) -> DataFrame:
    """Every CSV row: ``seq, user_id, ts, amount_change`` and what was found wrong with it.

    ``malformed`` holds the raw cells of a row that can't be typed, ``bad_time`` a time
    that can't be parsed, ``line`` the cells of a row with an empty cell or a zero amount.
    Movements of one instant keep their order in the file.
    """
    rows = sequence_in_files(cdc_csv_rows(spark, raw_path), *split_places(spark, raw_path), start)
    time_ = parse_cdc_ts("timestamp")
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "timestamp", "amount_change")])
    odd = F.col("user_id").isNull() | F.col("timestamp").isNull() | F.col("amount_change").isNull() | (F.col("amount_change") == 0)
    return rows.select(
        "seq", "user_id", default_null_ts(time_, dt.datetime.combine(as_of, dt.time())).alias("ts"), "amount_change",
        F.col("_corrupt").alias("malformed"), F.when(time_.isNull(), F.col("timestamp")).alias("bad_time"),
        F.when(F.col("_corrupt").isNull() & odd, line).alias("line"))


def split_cdc(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(cdc, quarantine, report)`` of parsed rows.

    Rows without a user can't enter the ledger and are quarantined like malformed ones; the
    other findings of ``cdc_validation`` are reported and stay, as in the reference.
    """
    typed = rows.where("malformed IS NULL")
    quarantine = (rows.where("malformed IS NOT NULL").select(F.col("malformed").alias("raw"), F.lit("malformed row").alias("reason"))
                  .unionByName(typed.where("user_id IS NULL").select(F.col("line").alias("raw"), F.lit("no user").alias("reason"))))
    report = (typed.where("bad_time IS NOT NULL").select(F.col("bad_time").alias("raw"), F.lit("unparseable timestamp").alias("reason"))
              .unionByName(typed.where("line IS NOT NULL AND user_id IS NOT NULL")
                           .select(F.col("line").alias("raw"), F.lit("empty time, or empty or zero amount").alias("reason"))))
    return typed.where("user_id IS NOT NULL").select("seq", "user_id", "ts", "amount_change"), quarantine, report


def with_balance(history: DataFrame) -> DataFrame:
    """Before a user's first amount the balance is 0 (movements may come without one)."""
    return history.withColumn("balance", F.coalesce("balance", F.lit(0)).cast(MONEY))


def build_history(spark: SparkSession, raw_path: str, as_of: dt.date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """CSV -> parsed CDC -> running balances. Returns ``(history, quarantine, report)``."""
    cdc, quarantine, report = split_cdc(parsed_cdc(spark, raw_path, as_of))
    return with_balance(wallet_history(cdc)), quarantine, report


class _Run:
    """What one run adds to the tables below a folder, and the facts of its commit."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg, self.base, self.id = spark, cfg, cfg.out_dir.rstrip("/"), cfg.run_id
        self.old = commit_facts(spark, self.base)
        self.facts = commit_facts(spark, self.base) | {"run": self.id, "version": self.id}
        self.staging = f"{self.base}/_staging/run={self.id}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Written once below the run's staging folder, which goes with the commit."""
        path = f"{self.staging}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def cdc(self) -> DataFrame:
        """The movements of the run's files, parsed in one pass; findings are published."""
        cfg, spark = self.cfg, self.spark
        start = self.old["next_seq"]
        rows = self.stage(parsed_cdc(spark, cfg.raw_cdc_path, cfg.as_of, start), "cdc")
        cdc, quarantine, report = split_cdc(rows)
        quarantine.write.mode("overwrite").parquet(f"{self.base}/quarantine/v={self.id}")
        report.write.mode("overwrite").parquet(f"{self.base}/cdc_report/v={self.id}")
        found = cdc.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.max("seq").alias("seq")).first()
        self.first_ts, self.last_ts = found.first, found.last
        if found.seq is not None:
            self.facts["next_seq"] = ((found.seq >> ROW_BITS) + 1) << ROW_BITS
        return cdc

    def seen(self, full: bool) -> None:
        """The times that the ledger spans."""
        spans = [(self.first_ts, self.last_ts)] + ([] if full else [tuple(
            t and dt.datetime.fromisoformat(t) for t in (self.old["first_ts"], self.old["last_ts"]))])
        spans = [s for s in spans if s[0] is not None]
        self.facts["first_ts"] = min(s[0] for s in spans).isoformat() if spans else None
        self.facts["last_ts"] = max(s[1] for s in spans).isoformat() if spans else None

    def add_history(self, rows: DataFrame) -> DataFrame:
        """Rows of the ledger with ``nxt``, written with a block of ids for each file."""
        path, spark = f"{self.base}/wallet_history", self.spark
        if "history_id" not in rows.columns:
            rows = rows.withColumn("history_id", F.lit(None).cast("long"))
        sinks.write_table(with_balance(rows), f"{path}/run={self.id}", STORED_HISTORY)
        files = allocate_ids(spark, path, STORED_HISTORY, self.id, self.old["next_history_id"], [])
        files.write.mode("overwrite").parquet(f"{self.base}/history_files/run={self.id}")
        added = spark.read.parquet(f"{self.base}/history_files/run={self.id}").agg(F.sum("rows")).first()[0]
        self.facts["next_history_id"] = self.old["next_history_id"] + (added or 0)
        return spark.read.schema(STORED_HISTORY).parquet(f"{path}/run={self.id}")

    def add_users(self, incoming: DataFrame) -> None:
        """The users not seen before; the others' files stay."""
        new = incoming.dropDuplicates(["user_id"]).join(read_users(self.spark, self.base, self.old), "user_id", "left_anti")
        sinks.write_table(new, f"{self.base}/users/run={self.id}", USERS)
        self.facts["user_runs"] = [*self.old["user_runs"], self.id]

    def load_rates(self) -> DataFrame:
        cfg, spark = self.cfg, self.spark
        bounds = spark.range(1).select(F.lit(self.first_ts).cast("date").alias("min_date"), F.lit(self.last_ts).cast("date").alias("max_date"))
        raw = read_rate_series(spark, cfg.rates_format, cfg.rates_path, with_order=True)
        rates, rejected = load_rates(raw, bounds, read_version(spark, self.base, "daily_interest_rates", DAILY_RATES, self.old), cfg.as_of)
        rejected.drop("file_order").write.mode("overwrite").parquet(f"{self.base}/rejected_rates/v={self.id}")
        return spark.read.schema(DAILY_RATES).parquet(publish(rates, f"{self.base}/daily_interest_rates", self.id, DAILY_RATES))

    def payable(self, rates: DataFrame, days: list[dt.date]) -> dict:
        """The rate in force on each day that has one and movements before it (one entry a day)."""
        first = self.facts["first_ts"]
        if not days or first is None:
            return {}
        asked = set(days)
        found = rate_asof(corrections.day_frame(self.spark, days), rates, self.cfg.thresholds).select("payout_date", "daily_rate").collect()
        return {r.payout_date: r.daily_rate for r in found
                if r.payout_date in asked and dt.datetime.fromisoformat(first) < dt.datetime.combine(r.payout_date, dt.time())}

    def add_payouts(self, rows: DataFrame, paid: dict) -> None:
        """Publish the rows of the days ``paid`` (with their rates); other days stay as they are.

        A paid day without rows ends up empty.
        """
        spark, path = self.spark, f"{self.base}/daily_bonus_payouts"
        sinks.write_table(rows, f"{path}/run={self.id}", STORED_PAYOUTS, partition_by=["payout_date"])
        written = read_runs(spark, path, STORED_PAYOUTS, [self.id])
        day_bitmaps(written).write.mode("overwrite").parquet(f"{self.base}/day_users/run={self.id}")
        new = allocate_ids(spark, path, STORED_PAYOUTS, self.id, self.old["next_payout_id"], ["payout_date"])
        day_rates = spark.createDataFrame(list(paid.items()), "payout_date date, daily_rate decimal(18,8)")
        new = (F.broadcast(day_rates).join(new, "payout_date", "left")
               .select("payout_date", F.lit(self.id).alias("run"), "file", F.coalesce("rows", F.lit(0)).alias("rows"), "first_id", "daily_rate"))
        kept = read_payout_days(spark, self.base, self.old).where(~F.col("payout_date").isin(list(paid)))
        publish(kept.unionByName(new), f"{self.base}/payout_days", self.id, PAYOUT_DAYS)
        added = read_payout_days(spark, self.base, self.facts).where(F.col("run") == self.id).agg(F.sum("rows")).first()[0]
        self.facts["next_payout_id"] = self.old["next_payout_id"] + (added or 0)

    def audit(self, rates: DataFrame, days: list[dt.date]) -> None:
        """Status, rate and totals of the days this run was asked for or has paid again."""
        spark = self.spark
        first = spark.range(1).select(F.lit(self.facts["first_ts"]).cast("timestamp_ntz").alias("ts"))
        paid = read_runs(spark, f"{self.base}/daily_bonus_payouts", STORED_PAYOUTS, [self.id])
        if days:
            audit = run_audit(first, rates, paid, one_row_period(spark, min(days), max(days)), self.cfg.thresholds)
            audit.where(F.col("payout_date").isin(days)).write.mode("overwrite").parquet(f"{self.base}/run_audit/v={self.id}")

    def commit(self) -> dict[str, str]:
        commit_run(self.spark, self.base, self.facts)
        remove(self.spark, self.staging)
        whole = ("ledger_state", "daily_interest_rates", "run_audit", "quarantine", "cdc_report", "rejected_rates", "payout_days")
        return ({t: f"{self.base}/{t}/v={self.id}" for t in whole}
                | {t: f"{self.base}/{t}" for t in ("users", "wallet_history", "daily_bonus_payouts")})


def pipeline_main(spark: SparkSession, cfg: PipelineConfig) -> dict[str, str]:
    """A full run over all CDC files: the ledger is written anew and its payouts, day by
    day, replace those of the days it covers."""
    run = _Run(spark, cfg)
    cdc = run.cdc()
    run.seen(full=True)
    run.add_users(user_ids_range(spark, cfg.num_users) if cfg.num_users else cdc.select("user_id"))
    written = run.add_history(wallet_history(cdc, with_next=True))
    run.facts |= {"history_runs": [run.id], "rebuilt_runs": []}
    # the state that the next increment starts from: rows without a next movement
    publish(written.where("nxt IS NULL").select("seq", "user_id", "ts", F.lit(None).cast(MONEY).alias("amount_change"), "balance"),
            f"{run.base}/ledger_state", run.id, STATE)
    rates = run.load_rates()
    bounds = spark.range(1).select(F.lit(run.first_ts).cast("date").alias("min_date"), F.lit(run.last_ts).cast("date").alias("max_date"))
    start, end = resolve_period(bounds, cfg.as_of, cfg.start, cfg.end).first()
    days = days_of([[start.isoformat(), end.isoformat()]]) if start and end and start <= end else []
    # a full run pays again whatever was ever paid
    others = [d for d in days_of(run.old["covered"]) if d not in set(days)]
    paid = run.payable(rates, days + others)
    rows = payouts_period(written, rates, one_row_period(spark, min(paid), max(paid)), cfg.thresholds) if paid else spark.createDataFrame([], DAILY_PAYOUTS)
    run.add_payouts(rows.where(F.col("payout_date").isin(list(paid))).withColumn("payout_id", F.lit(None).cast("long")), paid)
    if days:
        run.facts["covered"] = merge_periods(run.old["covered"], days[0], days[-1])
    run.audit(rates, sorted({*days, *paid}))
    return run.commit()


def pipeline_increment(spark: SparkSession, cfg: PipelineConfig) -> dict[str, str]:
    """A daily run that reads only the new CDC files.

    Balances of the new movements are extended from the stored per-user state and appended
    to the ledger as one run. Users with a movement older than their newest stored one are
    rebuilt from their whole history. The days of ``[cfg.start, cfg.end]`` are paid from the
    recent rows plus one snapshot row for each user. Days paid by earlier runs that the new
    movements or rates change are paid again (:mod:`walletyield.plans.corrections`), so
    ledger and payouts equal those of a full run over all files, in whatever order the
    movements arrive.
    """
    if cfg.start is None or cfg.end is None:
        raise ValueError("an incremental run needs the days to pay: start and end")
    run = _Run(spark, cfg)
    base, old = run.base, run.old
    cdc = run.cdc()
    run.seen(full=False)
    state = read_version(spark, base, "ledger_state", STATE, old).select("seq", "user_id", "ts", "balance")
    _, late = extend_history(state, cdc)
    rebuilt_dir = f"{base}/rebuilt_users/run={run.id}"
    late.select("user_id").distinct().write.mode("overwrite").parquet(rebuilt_dir)
    rebuilt = spark.read.schema("user_id long").parquet(rebuilt_dir)
    any_late = not rebuilt.isEmpty()
    fresh = cdc.join(rebuilt, "user_id", "left_anti") if any_late else cdc
    inc, _ = extend_history(state, fresh, with_next=True)
    if any_late:
        whole = (read_history(spark, base, old).select("seq", "user_id", "ts", "amount_change").unionByName(cdc)
                 .join(rebuilt, "user_id", "left_semi"))
        inc = inc.unionByName(wallet_history(whole, with_next=True).select(*inc.columns))
    written = run.add_history(inc)
    run.facts["history_runs"] = [*old["history_runs"], run.id]
    run.facts["rebuilt_runs"] = [*old["rebuilt_runs"], *([run.id] if any_late else [])]

    # state: users touched now take their newest row; others keep theirs
    newest = written.where("nxt IS NULL").select("seq", "user_id", "ts", "balance")
    publish(state.join(newest.select("user_id"), "user_id", "left_anti").unionByName(newest)
            .withColumn("amount_change", F.lit(None).cast(MONEY)), f"{base}/ledger_state", run.id, STATE)
    run.add_users(cdc.select("user_id"))
    rates = run.load_rates()

    # the period of this run, then earlier days that no longer hold
    days = days_of([[cfg.start.isoformat(), cfg.end.isoformat()]])
    others = [d for d in days_of(old["covered"]) if d not in set(days)]
    rate_of = run.payable(rates, days + others)
    paid = {d: r for d, r in rate_of.items() if cfg.start <= d <= cfg.end}
    lo = dt.datetime.combine(cfg.start, dt.time())
    if old["last_ts"] is None or dt.datetime.fromisoformat(old["last_ts"]) < lo:
        # every stored state row precedes the first paid day, so the snapshot before it is
        # the state plus this run's earlier rows: the old ledger is not read
        early = written.where(F.col("ts") < F.lit(lo).cast("timestamp_ntz")).select("seq", "user_id", "ts", "balance")
        before = ledger_state((state.join(rebuilt, "user_id", "left_anti") if any_late else state).unionByName(early))
        rows = payouts_since(written, rates, cfg.start, cfg.end, cfg.thresholds, before=before)
    else:
        open_ = F.col("nxt").isNull() | (F.col("nxt") >= F.lit(lo).cast("timestamp_ntz"))
        rows = payouts_period(read_intervals(spark, base, run.facts).where(open_), rates, one_row_period(spark, cfg.start, cfg.end), cfg.thresholds)
    rows = rows.where(F.col("payout_date").isin(list(paid))).withColumn("payout_id", F.lit(None).cast("long"))
    fixed, again = corrections.corrected_days(run, cdc, rates, others, rate_of)
    if fixed is not None:
        rows = rows.unionByName(fixed)
    run.add_payouts(rows, paid | again)
    run.facts["covered"] = merge_periods(old["covered"], cfg.start, cfg.end)
    run.audit(rates, sorted({*days, *again}))
    return run.commit()


def compact_history(spark: SparkSession, out_dir: str, run_id: int) -> None:
    """The ledger of all runs written as one, as its own commit; ids and the other tables stay.

    Readers of the runs before are not disturbed, as their files are left alone.
    """
    cfg = PipelineConfig("", "", out_dir, dt.date.min, run_id=run_id)
    run = _Run(spark, cfg)
    run.facts["version"] = run.old["version"]
    run.add_history(read_intervals(spark, run.base, run.old, ids=True).sortWithinPartitions("user_id", "ts", "seq"))
    run.facts["next_history_id"] = run.old["next_history_id"]
    run.facts |= {"history_runs": [run.id], "rebuilt_runs": []}
    commit_run(spark, run.base, run.facts)


def open_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The committed tables, also as views for :func:`walletyield.sources.sql_query`."""
    base = out_dir.rstrip("/")
    facts = commit_facts(spark, base)
    tables = {"users": read_users(spark, base, facts), "wallet_history": read_history(spark, base, facts, ids=True),
              "daily_interest_rates": read_version(spark, base, "daily_interest_rates", DAILY_RATES, facts),
              "daily_bonus_payouts": read_payouts(spark, base, facts, ids=True)}
    register_views(spark, tables)
    return tables


__all__ = ["PipelineConfig", "pipeline_main", "pipeline_increment", "build_history", "compact_history", "open_tables",
           "read_history", "read_payouts"]
