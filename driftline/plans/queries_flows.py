"""Registered queries: whole flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions.sizing import store
from driftline.operators import attribution as A
from driftline.plans import flows
from driftline.plans.queries_graph import BACK, IMPACT, VOTES, recursive
from driftline.plans.queries_review import ADVICE, RESOLVED, ROUTES, ROUTING
from driftline.plans.queries_trace import drift_findings
from driftline.plans.registry import DRIFT, TRACE, query
from driftline.sources import bindings as S


@query(f"""WITH {TRACE},
cut AS (SELECT *, max(ord) OVER (PARTITION BY session_id, signups ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak_here,
          lag(name) OVER (PARTITION BY session_id, signups ORDER BY step) AS before_here FROM trace WHERE signups > 0),
r AS (SELECT name AS stage, quantile_cont(value, [0.05, 0.95]) AS q FROM cut GROUP BY 1),
moves AS (SELECT before_here AS before, name AS stage, count(*) AS n FROM cut WHERE before_here IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT before, stage, n / sum(n) OVER (PARTITION BY before) AS support FROM moves),
visits AS (SELECT session_id, signups, name AS stage, min(step) AS at FROM cut GROUP BY 1, 2, 3),
pairs AS (SELECT a.stage AS before, b.stage, count(*) FILTER (a.at < b.at) / count(*) AS support FROM visits a JOIN visits b
          ON a.session_id = b.session_id AND a.signups = b.signups AND a.stage <> b.stage GROUP BY 1, 2),
wins AS (SELECT DISTINCT session_id, signups FROM cut),
must AS (SELECT stage FROM visits GROUP BY stage HAVING count(*) / (SELECT count(*) FROM wins) >= 0.5),
bad AS (
  SELECT session_id, signups, 0.5 AS severity FROM cut WHERE ord > coalesce(peak_here, 0) + 1
  UNION ALL SELECT session_id, signups, 0.3 FROM cut WHERE ord < peak_here
  UNION ALL SELECT session_id, signups, 0.2 FROM cut JOIN r ON r.stage = cut.name WHERE value < q[1] OR value > q[2]
  UNION ALL SELECT session_id, signups, 0.2 FROM cut WHERE before_here IN (SELECT before FROM shares WHERE support >= 0.5)
    AND (before_here, name) NOT IN (SELECT (before, stage) FROM shares WHERE support >= 0.5)
  UNION ALL SELECT a.session_id, a.signups, 0.3 FROM pairs p JOIN visits a ON a.stage = p.before JOIN visits b ON b.stage = p.stage
    AND a.session_id = b.session_id AND a.signups = b.signups WHERE p.support >= 0.5 AND a.at > b.at
  UNION ALL SELECT session_id, signups, 0.5 FROM wins, must WHERE (session_id, signups, stage) NOT IN (SELECT (session_id, signups, stage) FROM visits)),
t AS (SELECT session_id, signups, count(*) AS n, sum(severity) AS lost FROM bad GROUP BY 1, 2)
SELECT w.session_id, w.signups AS window_id, coalesce(n, 0) AS n_findings, round(1 - least(1.0, coalesce(lost, 0)), 6)::DOUBLE AS score
FROM wins w LEFT JOIN t ON t.session_id = w.session_id AND t.signups = w.signups""")
def flow_judge_skill(spark, sf_dir):
    """Skill windows, mined rules, deviations and a score per window."""
    trace = store(S.event_trace(spark, sf_dir))
    kinds = {"trace": F.col("name") == "click", "command": F.col("name") == "view", "diff": F.col("name") == "signup"}
    advice = spark.createDataFrame(ADVICE, "rule_kind string, advice string")
    judged = flows.judge_skill(trace, F.col("name") == "signup", 0.5, kinds, advice, ordinals=S.ORDINALS, skill="signup")
    return judged.scores.select("session_id", "window_id", "n_findings", F.round("score", 6).alias("score"))


@query(recursive(f"""{DRIFT}, {BACK}, {IMPACT},
c AS (
  SELECT b.session_id, symptom_id, d.step_id, d.step, d.rule_id,
    round(0.4 / (1 + depth) + 0.3 * d.severity + 0.2 * (symptom_step - d.step) / symptom_step
          + 0.1 * coalesce(rate_with / nullif(rate_with + rate_without, 0), 0), 9) AS score
  FROM back b JOIN drift d ON d.session_id = b.session_id AND d.step_id = b.step_id LEFT JOIN lift l ON l.name = d.stage),
best AS (SELECT session_id, arg_min(rule_id, (-score, step, rule_id, step_id)) AS cause FROM c GROUP BY 1),
m AS (SELECT session_id, arg_min(gate, (gate_step, gate_step_id)) AS gate FROM missed GROUP BY 1)
SELECT n.session_id, n.symptoms, cause, gate FROM (SELECT session_id, count(*) AS symptoms FROM shown GROUP BY 1) n
LEFT JOIN best USING (session_id) LEFT JOIN m USING (session_id)"""))
def flow_attribute(spark, sf_dir):
    """Symptoms to reports over the whole session graph."""
    trace = store(S.slim(S.event_trace(spark, sf_dir)))
    impact = A.event_impact(trace, S.event_outcome(trace))
    out = flows.attribute(trace, store(drift_findings(trace)), S.event_gates(trace), impact=impact)
    return out.reports.select("session_id", "symptoms", "cause", "gate")


@query(f"""WITH {RESOLVED}, {VOTES}, routes(cause, target) AS (VALUES {ROUTES}),
hard AS (SELECT r.finding_id FROM resolved r LEFT JOIN votes v USING (finding_id)
         WHERE (verdict = 'correct' AND cause IS DISTINCT FROM auto_cause) OR decision = 'split'),
sets AS (SELECT finding_id, CASE WHEN finding_id IN (SELECT finding_id FROM hard) THEN 'hard' ELSE 'golden' END AS set_name FROM resolved),
runs AS (SELECT CAST(doc_id AS VARCHAR) AS finding_id, 'base' AS version, n_chars >= 200 AS passed, CAST(n_chars AS DOUBLE) AS score FROM documents
         UNION ALL SELECT CAST(doc_id AS VARCHAR), 'candidate', n_chars >= 150, CAST(n_chars AS DOUBLE) FROM documents)
SELECT set_name, version, grouping(set_name, version)::BIGINT AS level, count(*) AS n, round(avg(passed::INT), 6) AS pass_rate
FROM runs JOIN sets USING (finding_id) GROUP BY GROUPING SETS ((set_name, version), (version), ())""")
def flow_close_loop(spark, sf_dir):
    """Verdicts to sets to the metrics of two versions."""
    docs = S.table(spark, sf_dir, "documents")

    def results(limit):
        return docs.select(F.col("doc_id").cast("string").alias("case_id"), (F.col("n_chars") >= limit).alias("passed"),
                           F.col("n_chars").cast("double").alias("score"))

    routing = spark.createDataFrame(ROUTING, "cause string, target string")
    done = flows.close_loop(S.document_auto(spark, sf_dir), S.document_verdicts(spark, sf_dir), S.document_votes(spark, sf_dir),
                            routing, results(200), results(150), {"pass_rate": 0.5}, 3, ["round"])
    return done.metrics.select("set_name", "version", "level", "n", F.round("pass_rate", 6).alias("pass_rate"))
