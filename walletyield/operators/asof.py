"""General by-key backward as-of join without a nested loop.

Both sides are unioned with a side flag and scanned once in
``(by, time, side, seq)`` order; every left row takes the last right row seen
so far (``last`` non-NULL). The scan is the skew-safe keyed scan, so a hot key
is split across tasks. ``strict=True`` puts left rows before right rows at
equal times (right time < left time); ``strict=False`` the other way round
(right time <= left time). ``tolerance`` drops matches older than it. As in
SQL, a NULL key or time matches nothing: such right rows are left out of the
scan, and left rows find nothing in a NULL key or before every time (NULLs
sort first), so both sides are read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.operators.scan import keyed_scan


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              *, strict: bool = True, tolerance=None, right_seq: str | None = None,
              right_cols: list[str] | None = None, prefix: str = "", **scan_opts) -> DataFrame:
    by = list(by)
    right_cols = [c for c in (right_cols or right.columns) if c not in by]
    lt = left.schema[left_on].dataType
    # side: 0 sorts first at equal time
    l_side, r_side = (0, 1) if strict else (1, 0)
    # keys and time stand in the scan's own columns; only the others ride along
    rest = [c for c in left.columns if c not in by and c != left_on]
    own_time = right_on in right_cols and right.schema[right_on].dataType == lt
    time_of = F.col(f"_match.{right_on if own_time else '_rt'}")
    payload = F.struct(*[F.col(c) for c in right_cols], *([] if own_time else [F.col(right_on).cast(lt).alias("_rt")])).alias("_payload")
    rseq = F.col(right_seq).cast("long") if right_seq else F.lit(0).cast("long")

    l = left.select(
        *[F.col(b) for b in by],
        F.col(left_on).alias("_t"), F.lit(l_side).alias("_side"),
        F.lit(0).cast("long").alias("_seq"),
        F.struct(*[F.col(c) for c in rest], *([] if rest else [F.lit(0).alias("_none")])).alias("_left"),
        F.lit(None).cast(right.select(payload).schema[0].dataType).alias("_payload"))
    r = right.select(
        *[F.col(b) for b in by],
        F.col(right_on).cast(lt).alias("_t"), F.lit(r_side).alias("_side"), rseq.alias("_seq"),
        F.lit(None).cast(l.schema["_left"].dataType).alias("_left"),
        payload)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, "_t"]])
    scanned = keyed_scan(l.unionByName(r.where(known)), by, ["_t", "_side", "_seq"],
                         {"_match": ("last", F.col("_payload"))}, **scan_opts)
    out = scanned.where(F.col("_side") == l_side)
    if tolerance is not None:
        out = out.withColumn("_match", F.when(time_of >= F.col("_t") - tolerance, F.col("_match")))
    of_left = {left_on: F.col("_t"), **{b: F.col(b) for b in by}}
    return out.select(*[of_left.get(c, F.col(f"_left.{c}")).alias(c) for c in left.columns],
                      *[F.col(f"_match.{c}").alias(prefix + c) for c in right_cols])
