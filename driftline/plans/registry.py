"""Where queries and the SQL they must agree with are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL giving the same rows if there is any."""
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return keep


# The event table as a trace: sessions end after gaps over 24 hours.
TRACE = """
e AS (
  SELECT event_id AS step_id, ts, CAST(user_id AS VARCHAR) AS owner, event_type AS name, value,
         json_extract_string(props, '$.k') AS k,
         strftime(date_trunc('week', ts), '%Y-%m-%d') AS version,
         CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END AS ord
  FROM events),
opened AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY owner ORDER BY ts, step_id) <= INTERVAL 24 HOUR
                 THEN 0 ELSE 1 END AS opens FROM e),
sess AS (
  SELECT *, concat(owner, '-', CAST(sum(opens) OVER (PARTITION BY owner ORDER BY ts, step_id
                                                     ROWS UNBOUNDED PRECEDING) AS VARCHAR)) AS session_id FROM opened),
stepped AS (
  SELECT *, row_number() OVER w AS step, lag(name) OVER w AS before, lag(ts) OVER w AS ts_before,
         max(ord) OVER (PARTITION BY session_id ORDER BY ts, step_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak,
         CAST(sum(CASE WHEN name = 'signup' THEN 1 ELSE 0 END) OVER (
           PARTITION BY session_id ORDER BY ts, step_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS signups
  FROM sess WINDOW w AS (PARTITION BY session_id ORDER BY ts, step_id)),
trace AS (
  SELECT *, CASE name WHEN 'signup' THEN 'context' WHEN 'view' THEN 'cognition' ELSE 'operation' END AS layer,
         CASE WHEN name IN ('view', 'error') THEN 'event' ELSE 'action' END AS kind FROM stepped)"""

# Skips and steps back on that trace, as findings.
DRIFT = TRACE + """,
drift AS (
  SELECT session_id, step_id, step, name AS stage, signups AS window_id,
         concat('skipped_step:', name) AS rule_id, 'skipped_step' AS rule_kind, 0.5::DOUBLE AS severity
  FROM trace WHERE ord > coalesce(peak, 0) + 1
  UNION ALL
  SELECT session_id, step_id, step, name, signups, concat('wrong_order:', name), 'wrong_order', 0.3::DOUBLE
  FROM trace WHERE ord < peak),
sup AS (
  SELECT session_id, step_id, ts, name, last_value(CASE WHEN name = 'click' THEN step_id END IGNORE NULLS) OVER (
    PARTITION BY session_id ORDER BY ts, step_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS proof
  FROM trace),
outcome AS (
  SELECT session_id, count(*) FILTER (name = 'purchase' AND proof IS NULL) = 0 AS good FROM sup GROUP BY session_id),
shown AS (SELECT session_id, step_id AS symptom_id, step AS symptom_step FROM trace WHERE name = 'error'),
firsts AS (
  SELECT session_id, min(step) AS first_step, arg_min(step_id, (step, rule_id)) AS first_step_id,
         arg_min(rule_id, (step, rule_id)) AS rule_id, arg_min(rule_kind, (step, rule_id)) AS rule_kind,
         arg_min(stage, (step, rule_id)) AS stage
  FROM drift GROUP BY session_id),
critical AS (
  SELECT s.session_id, symptom_id, symptom_step, first_step, first_step_id, rule_id, rule_kind, stage
  FROM shown s JOIN firsts f ON s.session_id = f.session_id AND first_step <= symptom_step),
gates AS (
  SELECT session_id, step_id, step, concat('view-', k) AS gate, value <= 100 AS passed FROM trace WHERE name = 'view'),
missed AS (
  SELECT c.session_id, c.symptom_id, g.step_id AS gate_step_id, g.step AS gate_step, g.gate
  FROM critical c JOIN gates g ON c.session_id = g.session_id AND g.passed
       AND g.step > c.first_step AND g.step <= c.symptom_step
  QUALIFY row_number() OVER (PARTITION BY c.session_id, c.symptom_id ORDER BY g.step) = 1)"""
