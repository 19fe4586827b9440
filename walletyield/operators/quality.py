"""Data-quality checks: keys, nulls, references, business rules, CDC records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.config import DEFAULT, TABLE_SCHEMAS, UNIQUE_KEYS, Thresholds
from walletyield.operators.asof import asof_join


def duplicate_keys(df: DataFrame, keys: list[str], count_col: str = "payment_count",
                   limit: int | None = None, order: list | None = None) -> DataFrame:
    """Key groups seen more than once (map-side partial counts, then a filter).

    With ``limit`` the result is a top-k under a total order (``order`` then
    the keys), planned as TakeOrderedAndProject.
    """
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)
    if limit is not None:
        out = out.orderBy(*(order or []), *keys).limit(limit)
    return out


def unique_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Generic UNIQUE / PRIMARY KEY check (NULL keys are not duplicates)."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return duplicate_keys(df.where(not_null), keys, count_col="n")


def not_null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: ``(column_name, null_count)``, one pass over the data."""
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                           F.coalesce(F.col(c), F.lit(0)).alias("null_count"))
                                  for c in cols]))
    return agg.select(stacked.alias("_s")).select("_s.column_name", "_s.null_count")


def fk_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is missing in the parent (NULL keys are not orphans).

    An anti join only tests existence, so the parent keys need no distinct;
    AQE splits a skewed child key across tasks (left side of an anti join).
    """
    pk = parent.select(F.col(parent_key or key).alias(key))
    return child.where(F.col(key).isNotNull()).join(pk, key, "left_anti")


def rule_check(payouts: DataFrame, history: DataFrame, cfg: Thresholds = DEFAULT,
               mode: str = "both", **scan_opts) -> DataFrame:
    """Payouts that break the eligibility rules, judged by the user's last
    movement before the payout day (an as-of join, not a nested loop).

    ``mode="both"``: amount > 0 AND balance <= min AND last move < hold
    before the day (the reference's check); ``mode="any"``: either rule.
    """
    snap = asof_join(payouts.withColumn("_day_ts", F.col("payout_date").cast("timestamp_ntz")),
                     history.select("user_id", "ts", "seq", "balance"),
                     by=["user_id"], left_on="_day_ts", right_on="ts", strict=True,
                     right_seq="seq", right_cols=["ts", "balance"], **scan_opts)
    snap = snap.where(F.col("ts").isNotNull())
    low = F.col("balance") <= F.lit(cfg.min_balance)
    recent = (F.col("_day_ts") - F.col("ts")) < F.make_dt_interval(F.lit(0), F.lit(cfg.hold_hours))
    rule = (low & recent) if mode == "both" else (low | recent)
    return (snap.where((F.col("calculated_amount") > 0) & rule)
            .select("payout_date", "user_id", "calculated_amount",
                    F.col("balance").alias("balance_at_start_of_day"),
                    F.col("ts").alias("last_movement")))


def cdc_validation(cdc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed CDC record check: user, timestamp and a non-zero amount present.

    Returns ``(valid, rejected)``; ``rejected`` carries the first failing
    ``reason``.
    """
    reason = (F.when(F.col("user_id").isNull(), F.lit("missing user_id"))
              .when(F.col("ts").isNull(), F.lit("missing timestamp"))
              .when(F.col("amount_change").isNull(), F.lit("missing amount_change"))
              .when(F.col("amount_change") == 0, F.lit("zero amount_change")))
    tagged = cdc.withColumn("reason", reason)
    return (tagged.where(F.col("reason").isNull()).drop("reason"),
            tagged.where(F.col("reason").isNotNull()))


def table_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared-constraint report for the known tables (``config.TABLE_SCHEMAS``).

    One row per check: ``(table_name, check, columns, violations)`` where
    ``not_null`` counts NULLs in a NOT NULL column and ``unique`` counts rows
    in key groups seen more than once. One aggregate pass per table for the
    NULL counts, one partial-aggregated shuffle per declared key.
    """
    parts = []
    for name, df in tables.items():
        schema = TABLE_SCHEMAS[name]
        nn = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
        if nn:
            nulls = not_null_violations(df, nn)
            parts.append(nulls.select(F.lit(name).alias("table_name"), F.lit("not_null").alias("check"),
                                      F.col("column_name").alias("columns"),
                                      F.col("null_count").cast("long").alias("violations")))
        for keys in UNIQUE_KEYS.get(name, []):
            if not all(k in df.columns for k in keys):
                continue
            dup = unique_key_violations(df, keys).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("v"))
            parts.append(dup.select(F.lit(name).alias("table_name"), F.lit("unique").alias("check"),
                                    F.lit(",".join(keys)).alias("columns"), F.col("v").alias("violations")))
    return reduce(lambda a, b: a.unionByName(b), parts)
