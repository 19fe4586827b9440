"""Readers: CDC CSV with quarantine, generic tables, rate series, logs, views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletyield.config import RAW_CDC_CSV


def file_order():
    """A column that sorts rows of a file scan as they stand in the files, by path:
    unique, and independent of how the files are split over tasks."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def cdc_csv_rows(spark: SparkSession, path: str, schema: T.StructType = RAW_CDC_CSV,
                 corrupt_col: str = "_corrupt", with_order: bool = True) -> DataFrame:
    """Header CSV read as text, then typed with ``try_cast``; all rows, once.

    A row with a cell that does not cast to the declared type has its raw cells in
    ``corrupt_col``. Typing after the read keeps the check independent of CSV column
    pruning. ``with_order`` adds ``file_order``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).csv(path)
    typed, bad = [], []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            typed.append(c.alias(f.name))
            continue
        v = F.trim(c).try_cast(f.dataType)
        typed.append(v.alias(f.name))
        bad.append(c.isNotNull() & (F.trim(c) != "") & v.isNull())
    is_bad = F.lit(False)
    for b in bad:
        is_bad = is_bad | b
    raw_line = F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields])
    order = [file_order().alias("file_order")] if with_order else []
    return raw.select(*typed, F.when(is_bad, raw_line).alias(corrupt_col), *order)


def read_cdc_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_CDC_CSV,
                 corrupt_col: str = "_corrupt", with_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(valid, corrupt)``: rows with a cell that does not cast go to ``corrupt`` (raw cells
    joined in ``_corrupt``) instead of entering the ledger as NULLs unnoticed."""
    out = cdc_csv_rows(spark, path, schema, corrupt_col, with_order)
    return (out.where(F.col(corrupt_col).isNull()).drop(corrupt_col),
            out.where(F.col(corrupt_col).isNotNull()))


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
               options: dict | None = None) -> DataFrame:
    """Generic scan; ``fmt="jdbc"`` takes url/dbtable and
    partitionColumn/lowerBound/upperBound/numPartitions through ``options``
    so the read is split over tasks."""
    r = spark.read.format(fmt).options(**(options or {}))
    return r.load(path) if path else r.load()


def read_rate_series(spark: SparkSession, fmt: str, path: str, lo: dt.date | None = None,
                     hi: dt.date | None = None, options: dict | None = None,
                     with_order: bool = False) -> DataFrame:
    """Annual rate files ``rate_date, annual_rate`` (rate kept as text until
    validated), filtered to ``[lo, hi]`` (pushed down to the scan); ``with_order``
    adds ``file_order``."""
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt == "csv":
        r = r.option("header", True).schema("rate_date date, annual_rate string")
    df = r.load(path).select(F.col("rate_date").cast("date").alias("rate_date"),
                             F.col("annual_rate").cast("string").alias("annual_rate"),
                             *([file_order().alias("file_order")] if with_order else []))
    if lo is not None:
        df = df.where(F.col("rate_date") >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col("rate_date") <= F.lit(hi))
    return df


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """Log file(s) as one ``value`` line per row (split across tasks)."""
    return spark.read.text(path)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql_query(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over registered views, with named parameters."""
    return spark.sql(query, args=args or None)


def user_ids_range(spark: SparkSession, n: int, start: int = 1) -> DataFrame:
    """Ids ``start .. n`` as a distributed range."""
    return spark.range(start, n + 1).select(F.col("id").alias("user_id"))
