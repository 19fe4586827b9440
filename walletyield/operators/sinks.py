"""Table maintenance as pure DataFrame transforms, plus writers.

Each publish computes the new table version as a DataFrame (anti-join +
union), then writes it once to a new location; nothing is deleted before
the replacement is complete (the reference committed a DELETE before its
append and could lose a day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walletyield.functions import iso_seconds
from walletyield.operators.scan import keyed_scan


def replace_days(target: DataFrame, new: DataFrame, processed_days: DataFrame,
                 day_col: str = "payout_date") -> DataFrame:
    """Idempotent per-day publish: drop every processed day, then add the new rows.

    A processed day whose new result is empty ends up empty (unlike dynamic
    partition overwrite, which would keep the stale partition). Days not in
    ``processed_days`` (no rate / no history) keep their old rows. The day
    list is one row per date, so it is broadcast.
    """
    days = F.broadcast(processed_days.select(day_col).distinct())
    kept = target.join(days, day_col, "left_anti")
    return kept.unionByName(new.select(*target.columns))


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert rows whose key is new (ON CONFLICT DO NOTHING); returns the new table."""
    new = incoming.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti")
    return current.unionByName(new.select(*current.columns))


def assign_surrogate_key(df: DataFrame, order: list[str], start: Column | int = 1,
                         id_col: str = "id", **scan_opts) -> DataFrame:
    """Dense, unique ids ``start, start+1, ...`` in ``order`` (a total order).

    A global running count computed as a two-level scan over range
    partitions (per-partition counts + prefix offsets), so no single task
    numbers all rows. ``start`` may be a column (e.g. ``max(id) + 1`` of the
    existing table, cross-joined as one row).
    """
    numbered = keyed_scan(df, [], list(order), {"_rn": ("count", F.lit(1))}, **scan_opts)
    s = start if isinstance(start, Column) else F.lit(start)
    return numbered.select((s.cast("long") + F.col("_rn") - F.lit(1)).alias(id_col), *df.columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema; keeps column comments as metadata."""
    cols = []
    for f in schema.fields:
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def not_null_guard(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the write (at run time, in the tasks) if a NOT NULL column has a NULL."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if not f.nullable:
            # the check sits inside the written value, so it can't be pruned away
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}"))) \
                .otherwise(c).cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def write_table(df: DataFrame, path: str | None, schema: T.StructType | None = None,
                partition_by: list[str] | None = None, mode: str = "overwrite",
                fmt: str = "parquet", cluster_by: list[str] | None = None,
                files: int | None = None, options: dict | None = None) -> None:
    """Write a table (schema enforced, optionally partitioned, e.g. by day).

    ``options`` go to the writer; with ``fmt="jdbc"`` they name the url and the
    table, and ``path`` is None (no database here: that form is not exercised).

    ``cluster_by`` range-partitions and sorts the rows on those columns
    before the write: every file covers a narrow key range (tight parquet
    min/max statistics, so later key filters skip files), and a hot key is
    spread over several files instead of one task (unlike a hash by key).
    """
    out = df
    if schema is not None:
        out = not_null_guard(conform(df, schema), schema)
    if cluster_by:
        n = files or int(out.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)
    elif partition_by:
        # a day's rows meet in few tasks, so a day is a few files, not one for each task
        salt = F.pmod(F.xxhash64(*out.columns), F.lit(files or 4))
        out = out.repartition(*partition_by, salt)
    w = out.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path) if path else w.save()


def write_cdc_csv(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Header CSV ``user_id,timestamp,amount_change`` with ISO-seconds times."""
    (df.select("user_id", iso_seconds(ts).alias("timestamp"), "amount_change")
       .write.mode("overwrite").option("header", True).csv(path))
