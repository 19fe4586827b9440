"""Skew-safe running aggregates per key ("keyed scan").

``Window.partitionBy(key)`` puts every row of a key into one task. When one
user (or one NULL key) holds a third of the rows, that task sorts a third of
the data alone. ``keyed_scan`` splits the work in two plans that are unioned:

* **normal keys** (fewer rows than ``total / fanout``): one hash exchange on
  the key, then a plain window. No key there can exceed ``1/fanout`` of the
  data. Hot keys are found by a key-only count with map-side partial
  aggregation; when there are none, this is the whole plan.
* **hot keys** (at most ``fanout`` of them, so the collected list has a
  proven bound and becomes an IN-list filter pushed to the scan): range-partitioned on ``(key, order...)`` so every task gets
  an equal contiguous slice of the global order, even inside one key. Each
  slice ("segment") computes its local scan; the segment totals (at most
  ``range_partitions + fanout`` rows) are combined by a small window and
  broadcast back as carry-in offsets. This is the classic two-level prefix
  scan, written with DataFrame operators only. The locally scanned hot rows
  are checkpointed to the shared checkpoint folder so that the segment
  totals and the rows come from the same range-partitioning run.

Supported scans are associative: ``sum``, ``count``, ``max``, ``min`` and
``last`` (last non-NULL value), plus ``maxoff`` = ``(expr, step)``: the
running max of ``expr - step * row_number`` (row numbers from 1 in the key),
whose carry-in shifts by the rows of earlier segments. ``leads`` gives the next row's value in the
same key (``lead(x, 1)``), also across segment borders.

Order columns must be ascending column names that make the order total
within a key (add a sequence column as the last tie-breaker). The input must
be deterministic (it is read once per branch), as any table or pure
projection of one is.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletyield.session import ensure_checkpoint_dir, shuffle_partitions
from walletyield.operators.common import with_scalars

_OPS = ("sum", "count", "max", "min", "last", "maxoff")


def _running(op: str, e: Column) -> Column:
    if op == "sum":
        return F.sum(e)
    if op == "count":
        return F.count(e)
    if op == "max":
        return F.max(e)
    if op == "min":
        return F.min(e)
    if op == "last":
        return F.last(e, ignorenulls=True)
    raise ValueError(f"unsupported scan {op!r}; use one of {_OPS}")


def _carry(op: str, e: Column) -> Column:
    """Aggregate of earlier segment totals (the carry-in)."""
    if op in ("sum", "count"):
        return F.sum(e)
    if op == "max":
        return F.max(e)
    if op == "min":
        return F.min(e)
    return F.last(e, ignorenulls=True)


def _combine(op: str, local: Column, carry: Column) -> Column:
    if op == "sum":
        return F.when(local.isNull() & carry.isNull(), F.lit(None)).otherwise(
            F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0)))
    if op == "count":
        return local + F.coalesce(carry, F.lit(0))
    if op == "max":
        return F.greatest(local, carry)
    if op == "min":
        return F.least(local, carry)
    return F.coalesce(local, carry)


def _null_safe_on(cols: list[str], prefix: str) -> Column:
    """``left.c <=> right.{prefix}c`` for every column (right side renamed)."""
    conds = [F.col(c).eqNullSafe(F.col(prefix + c)) for c in cols]
    return reduce(lambda a, b: a & b, conds)


def _renamed(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) if c in cols else F.col(c) for c in df.columns])


def _key_in(key: list[str], rows) -> Column:
    """Null-safe membership of the key in a small list of key tuples."""
    if len(key) == 1:
        vals = [r[0] for r in rows]
        present = [v for v in vals if v is not None]
        c = F.coalesce(F.col(key[0]).isin(present), F.lit(False)) if present else F.lit(False)
        return c | F.col(key[0]).isNull() if len(present) < len(vals) else c
    terms = [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(key, r)])
             for r in rows]
    return reduce(lambda a, b: a | b, terms)


def hot_keys(df: DataFrame, key: list[str], fanout: int) -> DataFrame:
    """Keys holding more than ``1/fanout`` of all rows: at most ``fanout`` rows.

    Counted with map-side partial aggregation, so a hot key is pre-aggregated
    before anything is shuffled.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return (with_scalars(counts, total)
            .where(F.col("_n") * F.lit(fanout) > F.col("_total"))
            .select(*key, "_n", "_total"))


def keyed_scan(df: DataFrame, key: list[str], order: list[str],
               scans: dict[str, tuple[str, Column]],
               leads: dict[str, Column] | None = None, *,
               fanout: int | None = None, range_partitions: int | None = None,
               split_hot: bool = True) -> DataFrame:
    """Append running aggregates (``scans``) and next-row values (``leads``).

    ``scans`` maps output name -> (op, expression); ``leads`` maps output
    name -> expression. Returns every input row once, with the new columns.
    ``fanout`` defaults to the shuffle partitions; ``range_partitions`` (the
    hot slices) defaults to the hot rows' share of ``fanout``, so a slice is
    as large as an average partition of the plain path.
    """
    key = list(key)
    order = list(order)
    leads = dict(leads or {})
    for op, _ in scans.values():
        if op not in _OPS:
            raise ValueError(f"unsupported scan {op!r}")
    spark = df.sparkSession
    fanout = int(fanout or shuffle_partitions(spark))
    base_cols = df.columns

    if not key:
        return _segmented(df, key, order, scans, leads, int(range_partitions or fanout), base_cols)

    w = Window.partitionBy(*key).orderBy(*order)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    simple = {n: v for n, v in scans.items() if v[0] != "maxoff"}
    offset = {n: v[1] for n, v in scans.items() if v[0] == "maxoff"}

    def plain(frame: DataFrame) -> DataFrame:
        out = frame.select(
            *base_cols,
            *[_running(op, e).over(wr).alias(n) for n, (op, e) in simple.items()],
            *[F.lead(e).over(w).alias(n) for n, e in leads.items()],
            *([F.count(F.lit(1)).over(wr).alias("_rn_aux")] if offset else []))
        if not offset:
            return out
        # same window spec: no second exchange or sort
        return out.select(
            *[c for c in out.columns if c != "_rn_aux"],
            *[F.max(e - F.lit(step) * F.col("_rn_aux")).over(wr).alias(n)
              for n, (e, step) in offset.items()]).select(*base_cols, *scans, *leads)

    if not split_hot:
        return plain(df)

    # At most ``fanout`` keys by construction (a key-only count with map-side
    # partial aggregation), so the list is small and bounded. When no key is
    # hot (the usual case) the plan is one exchange + window.
    hot = hot_keys(df, key, fanout).collect()
    if not hot:
        return plain(df)
    # slices of the same average size as the plain path's partitions
    hot_rows_n, total = sum(r["_n"] for r in hot), hot[0]["_total"]
    parts = int(range_partitions or max(1, -(-hot_rows_n * fanout // total)))
    is_hot = _key_in(key, hot)  # IN-list: pushed down to the scan, never NULL
    normal = plain(df.where(~is_hot))
    hot_rows = df.where(is_hot)
    seg = _segmented(hot_rows, key, order, scans, leads, parts, base_cols)
    # keep the plain path's types (carry-in sums widen decimals)
    seg = seg.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in normal.schema.fields])
    return normal.unionByName(seg)


def _segmented(df: DataFrame, key: list[str], order: list[str],
               scans: dict[str, tuple[str, Column]], leads: dict[str, Column],
               parts: int, base_cols: list[str]) -> DataFrame:
    """Two-level scan over range partitions of (key, order)."""
    ranged = df.repartitionByRange(parts, *key, *order) \
        .withColumn("_seg", F.spark_partition_id())
    ws = Window.partitionBy("_seg", *key).orderBy(*order)
    wsr = ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lead_names = list(leads)
    simple = {n: v for n, v in scans.items() if v[0] != "maxoff"}
    offset = {n: v[1] for n, v in scans.items() if v[0] == "maxoff"}
    local = ranged.select(
        *base_cols, "_seg",
        *[_running(op, e).over(wsr).alias(f"_l_{n}") for n, (op, e) in simple.items()],
        *[F.lead(e).over(ws).alias(f"_l_{n}") for n, e in leads.items()],
        F.lead(F.lit(1)).over(ws).isNull().alias("_seg_last"),
        F.count(F.lit(1)).over(wsr).alias("_lr"),
        *([F.struct(*[e.alias(n) for n, e in leads.items()]).alias("_lead_src")] if leads else []))
    if offset:
        local = local.select("*", *[F.max(e - F.lit(step) * F.col("_lr")).over(wsr).alias(f"_l_{n}")
                                    for n, (e, step) in offset.items()])
    # The segment ids come from one range exchange whose bounds are sampled
    # when it runs; both consumers below (segment totals and the rows) must
    # see the same run, so the local result is written to the shared
    # checkpoint folder (reliable: survives executor loss, cuts lineage).
    ensure_checkpoint_dir(df.sparkSession)
    # persisted first, so the checkpoint write doesn't recompute the slices
    local = local.persist(StorageLevel.MEMORY_AND_DISK)
    saved = local.checkpoint(eager=True)
    local.unpersist()
    local = saved

    ordkey = F.struct(*[F.col(o) for o in order])
    seg_aggs = [F.max_by(F.col(f"_l_{n}"), ordkey).alias(f"_t_{n}") for n in scans]
    seg_aggs.append(F.count(F.lit(1)).alias("_tn"))
    if leads:
        seg_aggs.append(F.min_by(F.col("_lead_src"), ordkey).alias("_first"))
    segs = local.groupBy("_seg", *key).agg(*seg_aggs)

    wk = Window.partitionBy(*key).orderBy("_seg") if key else Window.orderBy("_seg")
    wprev = wk.rowsBetween(Window.unboundedPreceding, -1)
    # rows in earlier segments of the key (the row-number carry)
    segs = segs.withColumn("_oc", F.coalesce(F.sum("_tn").over(wprev), F.lit(0)))
    offs = segs.select(
        "_seg", *key, "_oc",
        *[_carry(op, F.col(f"_t_{n}")).over(wprev).alias(f"_o_{n}") for n, (op, _) in simple.items()],
        *[F.max(F.col(f"_t_{n}") - F.lit(step) * F.col("_oc")).over(wprev).alias(f"_o_{n}")
          for n, (_, step) in offset.items()],
        *([F.lead("_first").over(wk).alias("_next_first")] if leads else []))
    # Bounded by range_partitions + number of hot keys: broadcast is safe.
    offs = F.broadcast(_renamed(offs, ["_seg", *key], "_ok_"))
    joined = local.join(offs, _null_safe_on(["_seg", *key], "_ok_"), "left")
    out_cols = [F.col(c) for c in base_cols]
    for n, (op, v) in scans.items():
        if op == "maxoff":
            shifted = F.col(f"_l_{n}") - F.lit(v[1]) * F.col("_oc")
            out_cols.append(F.greatest(F.col(f"_o_{n}"), shifted).alias(n))
        else:
            out_cols.append(_combine(op, F.col(f"_l_{n}"), F.col(f"_o_{n}")).alias(n))
    for n in lead_names:
        out_cols.append(F.when(F.col("_seg_last"), F.col("_next_first")[n])
                        .otherwise(F.col(f"_l_{n}")).alias(n))
    return joined.select(*out_cols)
