"""Queries: pipeline log analytics over log lines derived from events."""

from __future__ import annotations

import datetime as dt

from walletyield.operators import logs as G
from walletyield.plans import fixtures as X
from walletyield.plans.catalog import register

LEVELS = ["ERROR", "WARNING"]
LO, HI = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
SEARCH = "EVENT 1"


def _parsed(spark, sf):
    parsed, _ = G.log_parse(X.log_lines(spark, sf))
    return parsed


def _steps(spark):
    return X.PIPELINE_STEPS


@register("log_parse", "SELECT datetime, level, module, message FROM log_parsed")
def q_log_parse(spark, sf):
    return _parsed(spark, sf)


@register("log_unparsed", """
SELECT value FROM log_lines
WHERE NOT regexp_matches(value, '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2},\\d{3} \\[\\w+\\] [\\w.]+: ')""")
def q_log_unparsed(spark, sf):
    _, unparsed = G.log_parse(X.log_lines(spark, sf))
    return unparsed


@register("log_filter", """
SELECT datetime, level, module, message FROM log_parsed
WHERE level IN ('ERROR', 'WARNING')
  AND CAST(datetime AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND regexp_matches(message, 'EVENT 1', 'i')""")
def q_log_filter(spark, sf):
    return G.log_filter(_parsed(spark, sf), LEVELS, LO, HI, SEARCH)


@register("log_newest_first", "SELECT datetime, level, module, message FROM log_parsed ORDER BY datetime DESC")
def q_log_newest_first(spark, sf):
    return G.log_newest_first(_parsed(spark, sf))


@register("log_level_counts", 'SELECT level, COUNT(*) AS "count" FROM log_parsed GROUP BY level')
def q_log_level_counts(spark, sf):
    return G.log_level_counts(_parsed(spark, sf))


@register("log_timeline", """
SELECT date_trunc('minute', datetime) AS minute, COUNT(*) AS log_count FROM log_parsed GROUP BY 1""")
def q_log_timeline(spark, sf):
    return G.log_timeline(_parsed(spark, sf))


@register("log_summary", """
SELECT string_agg(DISTINCT level, ',' ORDER BY level) AS levels, min(datetime) AS first_entry,
       max(datetime) AS last_entry, COUNT(*) AS entries FROM log_parsed""")
def q_log_summary(spark, sf):
    from pyspark.sql import functions as F
    s = G.log_summary(_parsed(spark, sf))
    return s.select(F.array_join("levels", ",").alias("levels"), "first_entry", "last_entry", "entries")


@register("step_match", """
SELECT s.step_no, s.step, l.datetime, l.message
FROM log_parsed l JOIN steps s ON regexp_matches(l.message, s.step)""")
def q_step_match(spark, sf):
    return G.step_match(_parsed(spark, sf), _steps(spark)).select("step_no", "step", "datetime", "message")


@register("step_first_seen", """
SELECT s.step_no, s.step, min(l.datetime) AS start_time
FROM log_parsed l JOIN steps s ON regexp_matches(l.message, s.step) GROUP BY s.step_no, s.step""")
def q_step_first_seen(spark, sf):
    return G.step_first_seen(_parsed(spark, sf), _steps(spark))


@register("step_timings", """
WITH f AS (SELECT s.step_no, s.step, min(l.datetime) AS start_time
           FROM log_parsed l JOIN steps s ON regexp_matches(l.message, s.step) GROUP BY s.step_no, s.step),
m AS (SELECT max(datetime) AS newest FROM log_parsed),
t AS (SELECT f.*, coalesce(lead(start_time) OVER (ORDER BY step_no), m.newest) AS end_time FROM f, m)
SELECT step_no, step, start_time, end_time,
       (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_s FROM t""")
def q_step_timings(spark, sf):
    return G.step_timings(_parsed(spark, sf), _steps(spark))
