"""DuckDB SQL for the fixtures and queries (the correctness oracle).

Each query is plain SQL over the pre-registered test tables. Shared views
are written once as CTEs below and prepended on demand, in dependency
order. Definitions follow the per-day semantics of the reference directly
(nested snapshots, LATERAL-free but per-day), not our set-based plans, so
they check those plans independently.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


cte("cdc", """
SELECT event_id AS seq, user_id, ts,
       CAST(CASE WHEN event_type IN ('purchase', 'error') THEN -value ELSE value END AS DECIMAL(18,2)) AS amount_change
FROM events""")

cte("cdc_raw", """
SELECT seq, user_id,
       CASE WHEN seq % 97 = 0 THEN NULL
            WHEN seq % 101 = 0 THEN 'bad'
            WHEN seq % 103 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS ts,
       amount_change
FROM cdc""")

cte("history", """
SELECT seq, user_id, ts, amount_change,
       CAST(SUM(amount_change) OVER (PARTITION BY user_id ORDER BY ts, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance
FROM cdc""")

cte("annual_rates", """
SELECT d AS rate_date,
       11.65 + 0.05 * CAST((d - DATE '2023-12-25') % 9 AS DOUBLE) AS annual_rate
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM cdc)
WHERE dayofweek(d) NOT IN (0, 6)""")

cte("rates", """
SELECT rate_date,
       CAST(CAST(round(pow(1 + annual_rate / 100, CAST(1 AS DOUBLE) / 365) - 1, 10) AS DECIMAL(18,10)) AS DECIMAL(18,8)) AS daily_rate
FROM annual_rates""")

cte("bounds", """
SELECT min(CAST(ts AS DATE)) AS min_date, max(CAST(ts AS DATE)) AS max_date FROM cdc""")

cte("period", """
SELECT min_date + 1 AS start_date, least(DATE '2099-12-31', max_date) AS end_date FROM bounds""")

cte("days", """
SELECT CAST(unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS payout_date
FROM period""")

cte("rate_asof", """
SELECT d.payout_date, arg_max(r.daily_rate, r.rate_date) AS daily_rate, max(r.rate_date) AS rate_source_date
FROM days d JOIN rates r ON r.rate_date BETWEEN d.payout_date - 89 AND d.payout_date
GROUP BY d.payout_date""")

cte("snapshots", """
SELECT payout_date, user_id, balance AS balance_at_start_of_day, ts AS last_movement_timestamp FROM (
  SELECT d.payout_date, h.user_id, h.balance, h.ts,
         row_number() OVER (PARTITION BY d.payout_date, h.user_id ORDER BY h.ts DESC, h.seq DESC) AS rn
  FROM days d JOIN history h ON h.ts < CAST(d.payout_date AS TIMESTAMP)) WHERE rn = 1""")

cte("eligible", """
SELECT s.* FROM snapshots s
WHERE s.balance_at_start_of_day > 100
  AND date_trunc('second', s.last_movement_timestamp) <= CAST(s.payout_date AS TIMESTAMP) - INTERVAL 24 HOUR""")

cte("payouts", """
SELECT e.payout_date, e.user_id,
       CAST(e.balance_at_start_of_day * ra.daily_rate AS DECIMAL(18,2)) AS calculated_amount
FROM eligible e JOIN rate_asof ra ON ra.payout_date = e.payout_date""")

cte("payouts_seeded", """
SELECT payout_date, user_id, calculated_amount FROM payouts
UNION ALL
SELECT CAST(ts AS DATE) + 1 AS payout_date, user_id, CAST(1 AS DECIMAL(18,2)) AS calculated_amount
FROM cdc WHERE seq % 5 = 0""")

cte("log_lines", """
SELECT CASE WHEN event_id % 50 = 49 THEN '--- continuation line ---'
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || ' ['
       || CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'WARNING' ELSE 'INFO' END
       || '] src.' || event_type || ': '
       || CASE event_id WHEN 0 THEN 'Generating raw data...'
                        WHEN 100 THEN 'Inserting users into the database...'
                        WHEN 200 THEN 'Running wallet history calculation...'
                        WHEN 300 THEN 'Inserting daily rates into the database...'
                        WHEN 400 THEN 'Calculating CDI bonus for the period...'
                        ELSE 'event ' || CAST(event_id AS VARCHAR) || ' ' || event_type END
  END AS value
FROM events""")

cte("log_parsed", """
SELECT CAST(strptime(regexp_extract(value, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2},\\d{3}) \\[(\\w+)\\] ([\\w.]+): (.*)', 1), '%Y-%m-%d %H:%M:%S,%g') AS TIMESTAMP) AS datetime,
       regexp_extract(value, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2},\\d{3}) \\[(\\w+)\\] ([\\w.]+): (.*)', 2) AS level,
       regexp_extract(value, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2},\\d{3}) \\[(\\w+)\\] ([\\w.]+): (.*)', 3) AS module,
       regexp_extract(value, '^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2},\\d{3}) \\[(\\w+)\\] ([\\w.]+): (.*)', 4) AS message
FROM log_lines
WHERE regexp_matches(value, '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2},\\d{3} \\[\\w+\\] [\\w.]+: ')""")

cte("steps", """
SELECT * FROM (VALUES
  (1, 'Generating raw data...'),
  (2, 'Inserting users into the database...'),
  (3, 'Running wallet history calculation...'),
  (4, 'Inserting daily rates into the database...'),
  (5, 'Calculating CDI bonus for the period...')) AS t(step_no, step)""")

cte("daily_totals", """
SELECT payout_date, CAST(SUM(calculated_amount) AS DECIMAL(18,2)) AS total_payout
FROM payouts_seeded GROUP BY payout_date""")

cte("daily_users", """
SELECT payout_date, COUNT(DISTINCT user_id) AS eligible_users_count
FROM payouts_seeded GROUP BY payout_date""")


# The skewed ledger: a third of the rows moved to user 0.
cte("cdc_k", """
SELECT seq, CASE WHEN seq % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts, amount_change FROM cdc""")
for _n in ["history", "bounds", "period", "days", "rate_asof", "snapshots", "eligible", "payouts"]:
    CTES[_n + "_k"] = re.sub(r"\b(cdc|history|bounds|period|days|rate_asof|snapshots|eligible)\b",
                             lambda m: m.group(1) + "_k", CTES[_n])

# Second-precision variants (inputs that went through the CDC CSV, whose
# timestamps carry whole seconds): same definitions over ``cdc_s``.
cte("cdc_s", "SELECT seq, user_id, date_trunc('second', ts) AS ts, amount_change FROM cdc")
_SEC = ["history", "bounds", "period", "days", "rate_asof", "snapshots", "eligible", "payouts"]
for _n in _SEC:
    CTES[_n + "_s"] = re.sub(r"\b(cdc|history|bounds|period|days|rate_asof|snapshots|eligible)\b",
                             lambda m: m.group(1) + "_s", CTES[_n])


def _deps(sql: str) -> list[str]:
    seen: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in seen and re.search(rf"\b{re.escape(name)}\b", text):
                visit(CTES[name])
                if name not in seen:
                    seen.append(name)

    visit(sql)
    order = list(CTES)
    return sorted(seen, key=order.index)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it uses (transitively)."""
    names = _deps(sql)
    if not names:
        return sql.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in names)
    q = sql.strip()
    if re.match(r"(?is)^with\s", q):
        return f"WITH {body},\n{q[4:].lstrip()}"
    return f"WITH {body}\n{q}"
