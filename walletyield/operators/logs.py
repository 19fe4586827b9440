"""Pipeline log analytics: parse, filter, counts, timeline, step timings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: log line layout "yyyy-MM-dd HH:mm:ss,SSS [LEVEL] module: message"
LOG_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[(\w+)\] ([\w.]+): (.*)"
LOG_TS_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"


def log_parse(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Anchored regex -> ``datetime, level, module, message``.

    Non-matching lines (continuations of multi-line messages) are returned
    separately instead of being silently dropped.
    """
    v = F.col(col)
    ok = v.rlike(LOG_PATTERN)
    # One regex check, then plain string cuts: once the anchored pattern
    # matched, the time is the first 23 characters, the level runs to the
    # first ']', the module to the first ':' (neither group can contain
    # those), and the message is the rest of the line up to a newline (as
    # Python's and RE2's ``.``; Java's would also stop at U+2028 and kin).
    after_level = F.substr(v, F.lit(26))
    level = F.substring_index(after_level, "]", 1)
    after_module = F.substr(after_level, F.length(level) + F.lit(3))
    module = F.substring_index(after_module, ":", 1)
    parsed = lines.where(ok).select(
        F.try_to_timestamp(F.substring(v, 1, 23), F.lit(LOG_TS_FORMAT)).cast("timestamp_ntz").alias("datetime"),
        level.alias("level"),
        module.alias("module"),
        F.substring_index(F.substr(after_module, F.length(module) + F.lit(3)),
                          "\n", 1).alias("message"))
    unparsed = lines.where(~ok | ok.isNull())
    return parsed, unparsed


def log_filter(parsed: DataFrame, levels: list[str] | None = None, lo=None, hi=None,
               search: str | None = None) -> DataFrame:
    """Level in set, date in ``[lo, hi]`` inclusive, optional case-insensitive regex."""
    conds = []
    if levels is not None:
        conds.append(F.col("level").isin(list(levels)))
    d = F.to_date("datetime")
    if lo is not None:
        conds.append(d >= F.lit(lo).cast("date"))
    if hi is not None:
        conds.append(d <= F.lit(hi).cast("date"))
    if search:
        conds.append(F.coalesce(F.col("message").rlike("(?i)" + search), F.lit(False)))
    if not conds:
        return parsed
    return parsed.where(reduce(lambda a, b: a & b, conds))


def log_newest_first(parsed: DataFrame) -> DataFrame:
    """Newest entry first; entries of one instant by level, module and message."""
    return parsed.orderBy(F.col("datetime").desc(), "level", "module", "message")


def log_level_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("level").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "level")


def log_timeline(parsed: DataFrame) -> DataFrame:
    """Entries per minute; minutes without entries are absent."""
    minute = F.date_trunc("minute", F.col("datetime")).cast("timestamp_ntz")
    return parsed.groupBy(minute.alias("minute")).agg(F.count(F.lit(1)).alias("log_count"))


def log_summary(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.array_sort(F.collect_set("level")).alias("levels"),
                      F.min("datetime").alias("first_entry"),
                      F.max("datetime").alias("last_entry"),
                      F.count(F.lit(1)).alias("entries"))


def step_match(parsed: DataFrame, steps: list[str]) -> DataFrame:
    """``step_no, step`` and the log row, for each step pattern (a regex) that a message contains.

    The steps are a short list of literals, so each row tests them in one narrow pass.
    """
    found = F.array(*[F.when(F.col("message").rlike(s), F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step")))
                      for i, s in enumerate(steps, 1)])
    return parsed.withColumn("_s", F.explode(F.filter(found, lambda x: x.isNotNull()))) \
        .select(*parsed.columns, "_s.step_no", "_s.step")


def _first_seen(steps: list[str]):
    """An array of steps seen with the earliest matching time of each, as one aggregate."""
    seen = [F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"),
                     F.min(F.when(F.col("message").rlike(s), F.col("datetime"))).alias("start_time"))
            for i, s in enumerate(steps, 1)]
    return F.filter(F.array(*seen), lambda x: x["start_time"].isNotNull())


def step_first_seen(parsed: DataFrame, steps: list[str]) -> DataFrame:
    """Earliest matching entry per step: one pass, partial aggregation, one row."""
    return parsed.agg(_first_seen(steps).alias("_seen")).select(F.inline("_seen"))


def step_timings(parsed: DataFrame, steps: list[str]) -> DataFrame:
    """Start, end (next found step's start; the last runs to the newest
    entry) and duration in seconds; steps never seen are skipped, and an
    out-of-order step gives a negative duration, as in the reference."""
    one = parsed.agg(_first_seen(steps).alias("_seen"), F.max("datetime").alias("_newest"))
    ends = F.transform("_seen", lambda x, i: F.coalesce(F.get("_seen", i + 1)["start_time"], F.col("_newest")))
    out = one.select(F.explode(F.arrays_zip("_seen", ends.alias("end_time"))).alias("_z")) \
        .select("_z._seen.*", "_z.end_time")
    secs = (F.unix_micros(F.col("end_time").cast("timestamp")) -
            F.unix_micros(F.col("start_time").cast("timestamp"))) / F.lit(1e6)
    return out.select("step_no", "step", "start_time", "end_time", secs.alias("duration_s"))
