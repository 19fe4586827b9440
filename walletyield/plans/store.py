"""Committed tables below one folder, kept by reference.

Every run writes what it adds into directories of its own (``<table>/run=<id>``)
and names the runs that make up each table in one small commit file, written
last. A reader takes the newest commit: what a crashed run left behind is named
nowhere, and a retry gives the rows of one clean run. Nothing a run doesn't
change is copied:

* ``wallet_history``: the runs of the ledger in order; a run that rebuilt users
  replaces their earlier rows (``rebuilt_users/run=<id>``).
* ``daily_bonus_payouts``: ``payout_days/v=<id>`` says for every paid day which
  run holds its rows, so a run writes the days it pays and no other.
* ``users``: every run adds the users it has not seen before.

Ids (``history_id``, ``payout_id``) are dense over what the runs have written and
never change: a run takes a block of ids for each file it wrote, from the high-water
mark in the commit, by the files' row counts (their footers), and a row's id is the
first id of its file plus its place in the file. No row is moved to be numbered. Rows
that are written anew unchanged (a day with corrections, a compaction) carry theirs
along.

The commit file holds scalars, run ids and paid periods: its size follows the number
of runs since the last compaction. ``payout_days`` has one row for each day and file.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletyield.config import DAILY_PAYOUTS, RATE, USERS, WALLET_HISTORY
from walletyield.operators.bitmaps import DAY_USERS

#: Stored rows of the ledger: its schema, the next movement inside the run (the end of
#: the balance unless a later run goes on), and an id where a row brought one along.
STORED_HISTORY = T.StructType([*WALLET_HISTORY.fields, T.StructField("nxt", T.TimestampNTZType()),
                               T.StructField("history_id", T.LongType())])
STORED_PAYOUTS = T.StructType([*DAILY_PAYOUTS.fields, T.StructField("payout_id", T.LongType())])
#: One row for each file of a paid day; a day on which nobody is paid has a row without a file.
PAYOUT_DAYS = T.StructType([
    T.StructField("payout_date", T.DateType(), False), T.StructField("run", T.LongType(), False),
    T.StructField("file", T.StringType()), T.StructField("rows", T.LongType(), False),
    T.StructField("first_id", T.LongType()), T.StructField("daily_rate", RATE, False)])
FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()),
                      T.StructField("first_id", T.LongType()), T.StructField("run", T.LongType())])

EMPTY = {"run": None, "version": None, "next_seq": 0, "next_history_id": 1, "next_payout_id": 1, "history_runs": [], "rebuilt_runs": [],
         "user_runs": [], "covered": [], "first_ts": None, "last_ts": None}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def committed_runs(spark: SparkSession, base: str) -> list[int]:
    """Ids of the runs that wrote all their tables, oldest first."""
    p, fs = _fs(spark, f"{base}/_commits")
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[4:]) for n in names if n.startswith("run="))


def commit_run(spark: SparkSession, base: str, facts: dict) -> None:
    """The last step of a run. The file is complete before it gets the name that readers see."""
    run = facts["run"]
    part, fs = _fs(spark, f"{base}/_commits/_part-{run}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(facts).encode()))
    out.close()
    done, _ = _fs(spark, f"{base}/_commits/run={run}")
    fs.delete(done, False)
    if not fs.rename(part, done):
        raise RuntimeError(f"run {run} could not be committed")


def commit_facts(spark: SparkSession, base: str, run: int | None = None) -> dict:
    """What the newest commit (or a given one) says; the state of an empty folder before any."""
    base = base.rstrip("/")
    runs = [run] if run is not None else committed_runs(spark, base)[-1:]
    if not runs:
        return json.loads(json.dumps(EMPTY))
    text = spark.read.text(f"{base}/_commits/run={runs[0]}", wholetext=True).first()[0]
    return json.loads(text)


def read_runs(spark: SparkSession, path: str, schema: T.StructType, runs: list[int]) -> DataFrame:
    """Several runs of a table as one scan, with the partition column ``run``."""
    full = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
    if not runs:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/run={n}" for n in runs])


def allocate_ids(spark: SparkSession, path: str, runs_schema: T.StructType, run: int, first: int, by: list[str]) -> DataFrame:
    """``by``, file, rows, first_id of the files a run has written: blocks of ids in file order.

    Counts come from the files' footers; one window runs over one row for each file.
    """
    counts = (read_runs(spark, path, runs_schema, [run]).groupBy(*by, F.col("_metadata.file_name").alias("file"))
              .agg(F.count(F.lit(1)).alias("rows")))
    before = Window.orderBy(*by, "file").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first_id", F.lit(first) + F.coalesce(F.sum("rows").over(before), F.lit(0)))


def with_stored_ids(rows: DataFrame, files: DataFrame, on: list[str], id_col: str) -> DataFrame:
    """The id a row brought along, else its file's first id plus its place in the file.

    ``files`` has one row for each file; the rows of the table don't move.
    """
    place = rows.withColumns({"file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    keys = [*on, "file"]
    return (place.join(F.broadcast(files.select(*keys, "first_id")), keys)
            .withColumn(id_col, F.coalesce(id_col, F.col("first_id") + F.col("_row"))).drop("file", "_row", "first_id"))


def read_stored_history(spark: SparkSession, base: str, facts: dict, ids: bool = False) -> DataFrame:
    """The ledger's rows with ``run`` and ``nxt``; rebuilt users without their earlier rows."""
    rows = read_runs(spark, f"{base}/wallet_history", STORED_HISTORY, facts["history_runs"])
    if ids and facts["history_runs"]:
        files = spark.read.schema(FILES).option("basePath", f"{base}/history_files").parquet(
            *[f"{base}/history_files/run={n}" for n in facts["history_runs"]])
        rows = with_stored_ids(rows, files, ["run"], "history_id")
    if facts["rebuilt_runs"]:
        since = (read_runs(spark, f"{base}/rebuilt_users", T.StructType([T.StructField("user_id", T.LongType())]), facts["rebuilt_runs"])
                 .groupBy("user_id").agg(F.max("run").alias("_since")))
        rows = rows.join(since, "user_id", "left").where(F.col("_since").isNull() | (F.col("run") >= F.col("_since"))).drop("_since")
    return rows


def read_history(spark: SparkSession, base: str, facts: dict | None = None, ids: bool = False) -> DataFrame:
    """The ledger as committed, one scan over its runs; ``ids`` adds ``history_id``."""
    base = base.rstrip("/")
    rows = read_stored_history(spark, base, facts or commit_facts(spark, base), ids)
    return rows.select(*(["history_id"] if ids else []), *[f.name for f in WALLET_HISTORY])


def read_intervals(spark: SparkSession, base: str, facts: dict | None = None, ids: bool = False) -> DataFrame:
    """The ledger with ``nxt``, the user's next movement, without sorting it.

    A row that has a next movement inside its run keeps it. Of each user and run one row
    has none; its balance ends at the user's first row in a later run. Only these rows,
    one or two for each user and run, are gathered.
    """
    base = base.rstrip("/")
    facts = facts or commit_facts(spark, base)
    rows = read_stored_history(spark, base, facts, ids)
    cols = [*[f.name for f in WALLET_HISTORY], "nxt", *(["history_id"] if ids else [])]
    if len(facts["history_runs"]) < 2:
        return rows.select(*cols)
    begin = rows.groupBy("user_id", "run").agg(F.min("ts").alias("_first"))
    after = begin.withColumn("_after", F.lead("_first").over(Window.partitionBy("user_id").orderBy("run")))
    open_ = (rows.where("nxt IS NULL").join(after.select("user_id", "run", "_after"), ["user_id", "run"])
             .withColumn("nxt", F.col("_after")))
    return rows.where("nxt IS NOT NULL").select(*cols).unionByName(open_.select(*cols))


def read_payout_days(spark: SparkSession, base: str, facts: dict) -> DataFrame:
    return read_version(spark, base, "payout_days", PAYOUT_DAYS, facts)


def read_payouts(spark: SparkSession, base: str, facts: dict | None = None, since: dt.date | None = None, ids: bool = False) -> DataFrame:
    """The payouts as committed: for each paid day the files of the run that paid it last,
    as one scan. The list of directories has one entry for each paid day."""
    base = base.rstrip("/")
    facts = facts or commit_facts(spark, base)
    days = read_payout_days(spark, base, facts)
    if since is not None:
        days = days.where(F.col("payout_date") >= F.lit(since))
    held = days.where("file IS NOT NULL")
    folders = [f"{base}/daily_bonus_payouts/run={r.run}/payout_date={r.payout_date}" for r in held.select("run", "payout_date").distinct().collect()]
    cols = [*(["payout_id"] if ids else []), *[f.name for f in DAILY_PAYOUTS]]
    if not folders:
        return spark.createDataFrame([], STORED_PAYOUTS).select(*cols)
    full = T.StructType([*STORED_PAYOUTS.fields, T.StructField("run", T.LongType())])
    rows = spark.read.schema(full).option("basePath", f"{base}/daily_bonus_payouts").parquet(*sorted(folders))
    if ids:
        rows = with_stored_ids(rows, held, ["payout_date", "run"], "payout_id")
    return rows.select(*cols)


def read_users(spark: SparkSession, base: str, facts: dict | None = None) -> DataFrame:
    base = base.rstrip("/")
    facts = facts or commit_facts(spark, base)
    return read_runs(spark, f"{base}/users", USERS, facts["user_runs"]).select("user_id")


def read_version(spark: SparkSession, base: str, table: str, schema: T.StructType, facts: dict | None = None) -> DataFrame:
    """A table that every run writes whole (rates, ledger state, paid days): the version committed."""
    base = base.rstrip("/")
    run = (facts or commit_facts(spark, base))["version"]
    return spark.createDataFrame([], schema) if run is None else spark.read.schema(schema).parquet(f"{base}/{table}/v={run}")


def read_day_users(spark: SparkSession, base: str, facts: dict | None = None) -> DataFrame:
    """The user bitmaps of the paid days (:mod:`walletyield.operators.bitmaps`), by the runs
    that paid them last."""
    base = base.rstrip("/")
    facts = facts or commit_facts(spark, base)
    days = read_payout_days(spark, base, facts).where("file IS NOT NULL").select("payout_date", "run").distinct()
    runs = sorted(r.run for r in days.select("run").distinct().collect())
    return read_runs(spark, f"{base}/day_users", DAY_USERS, runs).join(F.broadcast(days), ["payout_date", "run"], "left_semi").drop("run")


def read_bounds(spark: SparkSession, base: str) -> DataFrame:
    """``(min_date, max_date)`` of the committed ledger, as ``period_bounds`` gives them,
    from the commit alone: no row and no file of the ledger is read."""
    facts = commit_facts(spark, base)
    first, last = (F.lit(facts[k]).cast("timestamp_ntz").cast("date") for k in ("first_ts", "last_ts"))
    return spark.range(1).select(first.alias("min_date"), last.alias("max_date"))


def merge_periods(periods: list[list[str]], start: dt.date, end: dt.date) -> list[list[str]]:
    """Paid periods (ISO dates, inclusive) with one more, overlapping and adjacent ones joined."""
    spans = sorted([(dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for a, b in periods] + [(start, end)])
    out = [list(spans[0])]
    for a, b in spans[1:]:
        if a <= out[-1][1] + dt.timedelta(days=1):
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [[a.isoformat(), b.isoformat()] for a, b in out]


def days_of(periods: list[list[str]]) -> list[dt.date]:
    return [dt.date.fromisoformat(a) + dt.timedelta(days=i) for a, b in periods
            for i in range((dt.date.fromisoformat(b) - dt.date.fromisoformat(a)).days + 1)]
