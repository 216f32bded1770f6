"""Registered queries: claims, evidence and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions.sizing import settle
from driftline.operators import claims as V
from driftline.operators import normalize as N
from driftline.operators import scoring as G
from driftline.operators import spec as P
from driftline.plans.queries_rules import FIELDS, MOVES, RANGES, THETA, held_state_trace
from driftline.plans.queries_trace import drift_findings
from driftline.plans.registry import DRIFT, TRACE, query
from driftline.sources import bindings as S


@query(f"""WITH {TRACE} SELECT session_id, step_id, step FROM trace WHERE name = 'purchase'""")
def v1_claims(spark, sf_dir):
    return S.event_claims(S.event_trace(spark, sf_dir)).select("session_id", "step_id", F.col("step").cast("bigint").alias("step"))


@query("""SELECT conv_id, turn FROM conversations
WHERE role = 'assistant' OR regexp_matches(text, '(?i)(^|[^a-z])(done|fixed|completed|finished|and)([^a-z]|$)')""")
def v1_claims_by_text(spark, sf_dir):
    talks = S.table(spark, sf_dir, "conversations").withColumn("name", F.col("role"))
    return V.claims(talks, ["assistant"], r"(?i)(^|[^a-z])(done|fixed|completed|finished|and)([^a-z]|$)").select("conv_id", "turn")


@query(f"""WITH {TRACE} SELECT session_id, step_id,
CASE name WHEN 'click' THEN 'trace' WHEN 'view' THEN 'command' ELSE 'diff' END AS evidence_kind
FROM trace WHERE name IN ('click', 'view', 'signup')""")
def v2_evidence(spark, sf_dir):
    return S.event_proofs(S.event_trace(spark, sf_dir)).select("session_id", "step_id", "evidence_kind")


@query(f"""WITH {DRIFT} SELECT session_id, step_id, proof AS evidence_step_id,
CASE WHEN proof IS NULL THEN 'unsupported' ELSE 'supported' END AS status FROM sup WHERE name = 'purchase'""")
def v3_claim_support(spark, sf_dir):
    return S.event_support(S.event_trace(spark, sf_dir)).select("session_id", "step_id", "evidence_step_id", "status")


@query(f"""WITH {DRIFT}
SELECT c.session_id, c.step_id, max(p.step_id) AS evidence_step_id,
       CASE WHEN count(p.step_id) > 0 THEN 'supported' ELSE 'unsupported' END AS status
FROM trace c LEFT JOIN trace p ON p.session_id = c.session_id AND p.name = 'click' AND p.ts < c.ts
     AND p.ts >= c.ts - INTERVAL 12 HOUR
WHERE c.name = 'purchase' GROUP BY c.session_id, c.step_id""")
def v3_claim_support_within(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return V.claim_support(S.event_claims(trace), S.event_evidence(trace), within="12 hours").select(
        "session_id", "step_id", "evidence_step_id", "status")


@query(f"""WITH {TRACE},
proofs AS (SELECT session_id, step_id, 'trace' AS evidence_kind FROM trace WHERE name = 'click'
           UNION ALL SELECT session_id, step_id, 'command' FROM trace WHERE name = 'view'
           UNION ALL SELECT session_id, step_id, 'diff' FROM trace WHERE name = 'signup'),
seen AS (SELECT t.session_id, t.step_id, t.name, last_value(p.step_id IGNORE NULLS) OVER w AS proof, last_value(p.evidence_kind IGNORE NULLS) OVER w AS kind
         FROM trace t LEFT JOIN proofs p USING (session_id, step_id)
         WINDOW w AS (PARTITION BY t.session_id ORDER BY t.ts, t.step_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT session_id, step_id, proof AS evidence_step_id, kind AS evidence_kind,
       CASE WHEN proof IS NULL THEN 'unsupported' ELSE 'supported' END AS status FROM seen WHERE name = 'purchase'""")
def v3_claim_support_tables(spark, sf_dir):
    """The same for claims and evidence given as two tables, with all three kinds."""
    trace = S.event_trace(spark, sf_dir)
    return V.claim_support(S.event_claims(trace), S.event_proofs(trace)).select(
        "session_id", "step_id", "evidence_step_id", "evidence_kind", "status")


@query("""WITH env AS (SELECT l_orderkey, count(*) FILTER (l_linestatus <> 'F') AS against FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN against IS NULL THEN 'missing' WHEN against > 0 THEN 'contradicted' ELSE 'supported' END AS status
FROM orders LEFT JOIN env ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'""")
def v4_false_success(spark, sf_dir):
    told = S.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    env = S.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    return V.false_success(told, env, "o_orderkey", F.col("l_linestatus") == "F")


@query(f"""WITH {DRIFT} SELECT t.session_id, count(*) AS n_rows FROM trace t JOIN outcome o USING (session_id)
WHERE NOT good GROUP BY t.session_id HAVING count(*) FILTER (name = 'error') = 0""")
def v5_silent_failures(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return V.silent_failures(trace, S.event_outcome(trace)).select("session_id", "n_rows")


@query(f"""WITH {DRIFT},
latest AS (SELECT session_id, step,
  last_value(CASE WHEN name = 'click' THEN step_id END IGNORE NULLS) OVER w AS t,
  last_value(CASE WHEN name = 'view' THEN step_id END IGNORE NULLS) OVER w AS c,
  last_value(CASE WHEN name = 'signup' THEN step_id END IGNORE NULLS) OVER w AS d
  FROM trace WINDOW w AS (PARTITION BY session_id ORDER BY step ROWS UNBOUNDED PRECEDING))
SELECT d.session_id, d.step_id, d.rule_id, l.t AS trace_ref, l.c AS command_ref, l.d AS diff_ref,
  (CASE WHEN l.t IS NULL THEN 0 ELSE 1 END + CASE WHEN l.c IS NULL THEN 0 ELSE 1 END
   + CASE WHEN l.d IS NULL THEN 0 ELSE 1 END)::BIGINT AS refs
FROM drift d JOIN latest l ON l.session_id = d.session_id AND l.step = d.step""")
def v6_attach_evidence(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    found = V.attach_evidence(drift_findings(trace), S.event_proofs(trace))

    def ref(kind):
        return F.get(F.filter("evidence", lambda e: e["kind"] == kind), 0)["step_id"].alias(f"{kind}_ref")

    return found.select("session_id", "step_id", "rule_id", ref("trace"), ref("command"), ref("diff"),
                        F.size("evidence").cast("bigint").alias("refs"))


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def v7_cites(spark, sf_dir):
    return V.cites(S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


@query(f"""WITH {TRACE}, {FIELDS}, {RANGES},
ex AS (SELECT stage, count(*) FILTER (field = 'k') AS k, count(*) FILTER (field = 'amount') AS amount
      FROM required WHERE support >= {THETA} GROUP BY stage)
SELECT session_id, step_id, (coalesce(ex.k, 0) + coalesce(ex.amount, 0) + 1)::BIGINT AS expected,
  round((coalesce(ex.k, 0) + CASE WHEN value <= 100 THEN coalesce(ex.amount, 0) ELSE 0 END
   + CASE WHEN value BETWEEN lo AND hi THEN 1 ELSE 0 END) / (coalesce(ex.k, 0) + coalesce(ex.amount, 0) + 1), 6) AS score
FROM trace JOIN ranges r ON r.stage = trace.name LEFT JOIN ex ON ex.stage = trace.name""")
def g1_output_scores(spark, sf_dir):
    trace = held_state_trace(spark, sf_dir)
    spec = settle(P.mine_fields(trace, THETA).unionByName(P.mine_ranges(trace, 0.05, 0.95)))
    return G.output_scores(trace, spec).select(
        "session_id", "step_id", F.col("expected").cast("bigint").alias("expected"), F.round("score", 6).alias("score"))


PROGRESS = """
progress AS (SELECT *, CASE WHEN ord IS NULL THEN 0 WHEN ord > coalesce(peak, 0) THEN 1 WHEN ord < peak THEN -1 ELSE 0 END AS move
             FROM trace)"""


@query(f"""WITH {TRACE}, {PROGRESS} SELECT session_id, step_id, move::BIGINT AS progress FROM progress""")
def g2_progress_steps(spark, sf_dir):
    return G.progress_steps(S.event_trace(spark, sf_dir), S.ORDINALS).select(
        "session_id", "step_id", F.col("progress").cast("bigint").alias("progress"))


@query(f"""WITH {TRACE}, {PROGRESS} SELECT session_id, sum(move)::BIGINT AS progress, count(*) AS n_rows FROM progress GROUP BY session_id""")
def g2_progress_scores(spark, sf_dir):
    return G.progress_scores(S.event_trace(spark, sf_dir), S.ORDINALS).select("session_id", "progress", "n_rows")


WINDOW_FINDINGS = """
cut AS (SELECT *, max(ord) OVER (PARTITION BY session_id, signups ORDER BY step
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak_here FROM trace WHERE signups > 0),
bad AS (SELECT session_id, signups AS window_id,
          CASE WHEN ord > coalesce(peak_here, 0) + 1 THEN 0.5 WHEN ord < peak_here THEN 0.3 END::DOUBLE AS severity FROM cut),
win AS (SELECT session_id, window_id, count(severity) AS n_findings,
          round(1 - least(1.0, coalesce(sum(severity), 0)), 6)::DOUBLE AS score FROM bad GROUP BY 1, 2)"""


@query(f"""WITH {TRACE}, {WINDOW_FINDINGS} SELECT session_id, window_id, n_findings, score FROM win""")
def g3_skill_scores(spark, sf_dir):
    return window_scores(spark, sf_dir).select("session_id", "window_id", "n_findings", "score")


def window_scores(spark, sf_dir):
    cut = N.skill_windows(S.event_trace(spark, sf_dir), F.col("name") == "signup")
    return G.skill_scores(drift_findings(cut), cut).withColumn("score", F.round("score", 6))


@query(f"""WITH {TRACE}, {MOVES},
c AS (SELECT t.session_id, round(avg(-ln(support)), 9) AS surprise, count(*) AS moves
      FROM trace t JOIN shares s ON s.before = t.before AND s.stage = t.name GROUP BY 1),
m AS (SELECT quantile_cont(surprise, 0.5) AS mid FROM c),
d AS (SELECT quantile_cont(abs(surprise - mid), 0.5) AS mad FROM c, m)
SELECT session_id, moves, round(surprise, 6) AS surprise, round(0.6745 * (surprise - mid) / mad, 4) AS robust_z FROM c, m, d""")
def g4_trajectory_anomaly(spark, sf_dir):
    return G.trajectory_anomaly(S.event_trace(spark, sf_dir)).select(
        "session_id", "moves", F.round("surprise", 6).alias("surprise"), F.round("robust_z", 4).alias("robust_z"))


CONTEXTS = """
steps AS (SELECT session_id, step, name, lag(name, 1) OVER w AS a, lag(name, 2) OVER w AS b, lag(name, 3) OVER w AS c FROM trace WINDOW w AS (PARTITION BY session_id ORDER BY step)),
moves AS (SELECT * FROM steps WHERE a IS NOT NULL),
c1 AS (SELECT a, name, count(*) AS n FROM moves GROUP BY ALL),
c2 AS (SELECT a, b, name, count(*) AS n FROM moves WHERE b IS NOT NULL GROUP BY ALL),
c3 AS (SELECT a, b, c, name, count(*) AS n FROM moves WHERE c IS NOT NULL GROUP BY ALL),
p1 AS (SELECT *, n / sum(n) OVER (PARTITION BY a) AS p FROM c1),
p2 AS (SELECT *, n / sum(n) OVER (PARTITION BY a, b) AS p FROM c2),
p3 AS (SELECT *, n / sum(n) OVER (PARTITION BY a, b, c) AS p FROM c3),
g2 AS (SELECT p2.a, p2.b, round(sum(p2.n * ln(p2.p / p1.p)), 9) AS gain FROM p2 JOIN p1 USING (a, name) GROUP BY ALL HAVING gain >= 4),
g3 AS (SELECT p3.a, p3.b, p3.c, round(sum(p3.n * ln(p3.p / p2.p)), 9) AS gain FROM p3 JOIN p2 USING (a, b, name) GROUP BY ALL HAVING gain >= 4)"""


@query(f"""WITH {TRACE}, {CONTEXTS}
SELECT a AS context, name AS stage, n, round(p, 6) AS p, NULL::DOUBLE AS gain FROM p1
UNION ALL SELECT concat(a, '<', b), name, n, round(p, 6), round(gain, 6) FROM p2 JOIN g2 USING (a, b)
UNION ALL SELECT concat(a, '<', b, '<', c), name, n, round(p, 6), round(gain, 6) FROM p3 JOIN g3 USING (a, b, c)""")
def g4_context_tree(spark, sf_dir):
    return G.context_tree(S.event_trace(spark, sf_dir), 3, 4.0).select(
        F.array_join("context", "<").alias("context"), "stage", "n", F.round("p", 6).alias("p"), F.round("gain", 6).alias("gain"))


@query(f"""WITH {TRACE}, {CONTEXTS},
q AS (SELECT m.session_id, -ln(CASE WHEN g3.gain IS NOT NULL THEN p3.p WHEN g2.gain IS NOT NULL THEN p2.p ELSE p1.p END) AS cost
      FROM moves m JOIN p1 ON p1.a = m.a AND p1.name = m.name
      LEFT JOIN p2 ON p2.a = m.a AND p2.b = m.b AND p2.name = m.name LEFT JOIN g2 ON g2.a = m.a AND g2.b = m.b
      LEFT JOIN p3 ON p3.a = m.a AND p3.b = m.b AND p3.c = m.c AND p3.name = m.name LEFT JOIN g3 ON g3.a = m.a AND g3.b = m.b AND g3.c = m.c),
c AS (SELECT session_id, round(avg(cost), 9) AS surprise, count(*) AS moves FROM q GROUP BY 1),
m AS (SELECT quantile_cont(surprise, 0.5) AS mid FROM c),
d AS (SELECT quantile_cont(abs(surprise - mid), 0.5) AS mad FROM c, m)
SELECT session_id, moves, round(surprise, 6) AS surprise, round(0.6745 * (surprise - mid) / mad, 4) AS robust_z FROM c, m, d""")
def g4_context_anomaly(spark, sf_dir):
    return G.context_anomaly(S.event_trace(spark, sf_dir), 3, 4.0).select(
        "session_id", "moves", F.round("surprise", 6).alias("surprise"), F.round("robust_z", 4).alias("robust_z"))


@query(f"""WITH {TRACE}, t AS (SELECT session_id, concat(session_id, '/', signups) AS task_id, name AS stage, CAST(step AS BIGINT) AS step, value FROM trace)
SELECT session_id, task_id, stage, step, grouping(session_id, task_id, stage, step)::BIGINT AS level, count(*) AS n_rows, round(avg(value), 6) AS mean_score
FROM t GROUP BY ROLLUP (session_id, task_id, stage, step)""")
def g5_level_rollup(spark, sf_dir):
    return G.level_rollup(S.event_trace(spark, sf_dir), F.col("value")).withColumns({
        "mean_score": F.round("mean_score", 6), "step": F.col("step").cast("bigint")})


@query(f"""WITH {TRACE}, {WINDOW_FINDINGS} SELECT session_id, window_id, score FROM win ORDER BY score, session_id, window_id LIMIT 50""")
def g6_worst(spark, sf_dir):
    return G.worst(window_scores(spark, sf_dir), 50, ids=["session_id", "window_id"]).select("session_id", "window_id", "score")


@query(f"""WITH {TRACE}, {WINDOW_FINDINGS} SELECT session_id, window_id, score, place FROM (
SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY score, window_id) AS place FROM win) WHERE place <= 2""")
def g6_worst_per_session(spark, sf_dir):
    return G.worst(window_scores(spark, sf_dir), 2, ids=["window_id"], by=["session_id"]).select(
        "session_id", "window_id", "score", F.col("place").cast("bigint").alias("place"))
