"""Distinct users as exact bitmaps that can be kept by day and merged.

A day's users are one bit each in buckets of 32,768 ids; bitmaps of several days, runs or
copies of a row are merged by OR, so a distinct count over any set of days reads a few
kilobytes for each bucket and day, never the payouts, and duplicates count once. Built with
map-side partial aggregation from Spark's bitmap functions. Rows without a user don't count;
ids are numbers of any size, also negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_USERS = T.StructType([T.StructField("payout_date", T.DateType()), T.StructField("bucket", T.LongType()),
                          T.StructField("users", T.BinaryType())])


def day_bitmaps(payouts: DataFrame, day_col: str = "payout_date", user_col: str = "user_id") -> DataFrame:
    """``payout_date, bucket, users``: the bitmap of each day and bucket of ids."""
    return (payouts.where(F.col(user_col).isNotNull())
            .groupBy(F.col(day_col).alias("payout_date"), F.bitmap_bucket_number(F.col(user_col)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user_col))).alias("users")))


def users_by_day(bitmaps: DataFrame) -> DataFrame:
    """Distinct users of each day (several bitmaps of a day and bucket are merged)."""
    return _counted(bitmaps, ["payout_date"])


def users_by_month(bitmaps: DataFrame) -> DataFrame:
    """Distinct users of each month, though a user is paid on many of its days."""
    return _counted(bitmaps.withColumn("month", F.trunc("payout_date", "month")), ["month"])


def _counted(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("eligible_users"))
