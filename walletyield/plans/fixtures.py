"""Views over the bundled test tables (see FIXTURES.md).

The reference's inputs (a CDC feed, an annual rate series, pipeline logs)
are derived from ``events`` so every query's work grows with the tables.
The oracle SQL in :mod:`walletyield.plans.oracle` defines the same views.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.config import MONEY
from walletyield.functions import iso_seconds
from walletyield.operators.ledger import wallet_history
from walletyield.operators.rates import annual_to_daily_rate
from walletyield.plans.payouts import auto_period, payouts_period

# Far enough in the future that the auto period ends at the newest movement.
AS_OF = dt.date(2100, 1, 1)
AS_OF_TS = dt.datetime(2100, 1, 1, 0, 0, 0)

# fixed values: the pipeline step messages searched in the logs
PIPELINE_STEPS = [
    "Generating raw data...",
    "Inserting users into the database...",
    "Running wallet history calculation...",
    "Inserting daily rates into the database...",
    "Calculating CDI bonus for the period...",
]

RATE_START = dt.date(2023, 12, 25)


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a bundled table; the relation (not its data) is reused per session
    so repeated plans skip the file listing and footer read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    k = (id(spark), spark.sparkContext.applicationId, path)
    if k not in _TABLES:
        _TABLES[k] = spark.read.parquet(path)
    return _TABLES[k]


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    signed = F.when(F.col("event_type").isin("purchase", "error"), -F.col("value")).otherwise(F.col("value"))
    return e.select(F.col("event_id").alias("seq"), "user_id",
                    F.col("ts").cast("timestamp_ntz").alias("ts"),
                    signed.cast(MONEY).alias("amount_change"))


def cdc_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CDC feed with a third of all rows moved to one user (user 0): the
    hot-key case the keyed scan must split."""
    c = cdc(spark, sf_dir)
    return c.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit(0).cast("long"))
                        .otherwise(F.col("user_id")))


def cdc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cdc(spark, sf_dir)
    s = F.col("seq")
    text = (F.when(s % 97 == 0, F.lit(None).cast("string"))
            .when(s % 101 == 0, F.lit("bad"))
            .when(s % 103 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .otherwise(iso_seconds("ts")))
    return c.select("seq", "user_id", text.alias("ts"), "amount_change")


def history(spark: SparkSession, sf_dir: str, with_next: bool = False, **scan_opts) -> DataFrame:
    return wallet_history(cdc(spark, sf_dir), with_next=with_next, **scan_opts)


def annual_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published annual rate for every weekday with events (weekends are
    missing, so the look-back is used): the series is derived from the
    ledger's own calendar, ``11.65 + 0.05 * (days since 2023-12-25 mod 9)``."""
    days = cdc(spark, sf_dir).select(F.to_date("ts").alias("rate_date")).distinct()
    n = F.datediff("rate_date", F.lit(RATE_START))
    return (days.where(~F.dayofweek("rate_date").isin(1, 7))
            .select("rate_date", (F.lit(11.65) + F.lit(0.05) * (n % 9).cast("double")).alias("annual_rate")))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annual_to_daily_rate(annual_rates(spark, sf_dir))


def period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auto_period(cdc(spark, sf_dir), AS_OF)


def payouts(spark: SparkSession, sf_dir: str, **scan_opts) -> DataFrame:
    h = history(spark, sf_dir, with_next=True, **scan_opts)
    return payouts_period(h, rates(spark, sf_dir), period(spark, sf_dir))


def payouts_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeded = cdc(spark, sf_dir).where(F.col("seq") % 5 == 0).select(
        F.date_add(F.to_date("ts"), 1).alias("payout_date"), "user_id",
        F.lit(1).cast(MONEY).alias("calculated_amount"))
    return payouts(spark, sf_dir).unionByName(seeded)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    level = (F.when(F.col("event_type") == "error", F.lit("ERROR"))
             .when(F.col("event_type") == "purchase", F.lit("WARNING"))
             .otherwise(F.lit("INFO")))
    msg = F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" "), F.col("event_type"))
    for i, step in enumerate(PIPELINE_STEPS):
        msg = F.when(F.col("event_id") == i * 100, F.lit(step)).otherwise(msg)
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" ["), level,
                    F.lit("] src."), F.col("event_type"), F.lit(": "), msg)
    return e.select(F.when(F.col("event_id") % 50 == 49, F.lit("--- continuation line ---"))
                    .otherwise(line).alias("value"))
