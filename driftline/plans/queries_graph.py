"""Registered queries: the session graph and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions.columns import signature
from driftline.functions.ordered import previous, running
from driftline.functions.sizing import settle, store
from driftline.operators import attribution as A
from driftline.operators import consensus as K
from driftline.operators import claims as V
from driftline.operators import graph as B
from driftline.plans.queries_trace import conform, drift_findings, scratch
from driftline.plans.registry import DRIFT, TRACE, query
from driftline.sources import bindings as S
from driftline.sources import schemas
from driftline.sources import tables as IO

DEPTH = 5

GRAPH = """
artifacts AS (SELECT session_id, lag(step_id) OVER (PARTITION BY session_id, k ORDER BY step) AS src, step_id AS dst
              FROM trace WHERE k IS NOT NULL),
edges AS (
  SELECT session_id, lag(step_id) OVER (PARTITION BY session_id ORDER BY step) AS src, step_id AS dst, 'next' AS edge_kind FROM trace
  UNION ALL SELECT session_id, src, dst, 'artifact' FROM artifacts)"""

BACK = GRAPH + f""",
links AS (SELECT DISTINCT session_id, src, dst FROM edges WHERE src IS NOT NULL),
walk AS (
  SELECT session_id, symptom_id, symptom_step, symptom_id AS step_id, 0 AS depth, [symptom_id] AS path FROM shown
  UNION ALL
  SELECT w.session_id, symptom_id, symptom_step, l.src, depth + 1, list_append(path, l.src)
  FROM walk w JOIN links l ON l.session_id = w.session_id AND l.dst = w.step_id WHERE depth < {DEPTH}),
back AS (
  SELECT session_id, symptom_id, symptom_step, step_id, depth, min(path) AS path FROM walk
  GROUP BY session_id, symptom_id, symptom_step, step_id, depth
  QUALIFY row_number() OVER (PARTITION BY session_id, symptom_id, step_id ORDER BY depth) = 1)"""


def recursive(sql: str) -> str:
    return "WITH RECURSIVE " + sql


@query(f"WITH {TRACE}, {GRAPH} SELECT session_id, src, dst, edge_kind FROM edges WHERE src IS NOT NULL")
def a1_build_graph(spark, sf_dir):
    _, edges = B.build_graph(S.event_trace(spark, sf_dir))
    return edges


@query(f"""WITH {DRIFT},
f AS (SELECT session_id, step_id, count(*) AS n_findings, max(severity) AS severity, string_agg(rule_id, ',' ORDER BY rule_id) AS rules
      FROM drift GROUP BY 1, 2)
SELECT t.session_id, t.step_id, t.kind, coalesce(n_findings, 0) AS n_findings, severity, rules
FROM trace t LEFT JOIN f ON f.session_id = t.session_id AND f.step_id = t.step_id""")
def a2_link_findings(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    nodes, _ = B.build_graph(trace)
    return B.link_findings(nodes, drift_findings(trace)).select(
        "session_id", "step_id", "kind", "n_findings", "severity", F.array_join("rules", ",").alias("rules"))


@query(f"""WITH {DRIFT},
bad AS (SELECT t.session_id, max(step) AS step, arg_max(step_id, step) AS step_id, count(*) FILTER (name = 'error') AS errors
        FROM trace t JOIN outcome o USING (session_id) WHERE NOT good GROUP BY t.session_id)
SELECT session_id, step_id, step, 'error' AS source FROM trace WHERE name = 'error'
UNION ALL SELECT session_id, step_id, step, 'feedback' FROM bad
UNION ALL SELECT session_id, step_id, step, 'outcome' FROM bad WHERE errors = 0""")
def a3_symptoms(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    outcome = settle(S.event_outcome(trace))
    feedback = outcome.where("not good").select("session_id", F.lit(None).cast("bigint").alias("step_id"))
    shown = B.symptoms(trace, feedback, V.silent_failures(trace, outcome))
    return shown.select("session_id", "step_id", F.col("step").cast("bigint").alias("step"), "source")


def traced(trace):
    _, edges = B.build_graph(trace)
    return B.trace_back(edges, B.symptoms(trace), DEPTH)


@query(recursive(f"""{DRIFT}, {BACK}
SELECT session_id, symptom_id, step_id, depth::BIGINT AS depth, array_to_string(path, '<') AS path FROM back"""))
def a4_trace_back(spark, sf_dir):
    back = traced(S.event_trace(spark, sf_dir))
    return back.select("session_id", "symptom_id", "step_id", F.col("depth").cast("bigint").alias("depth"),
                       F.array_join(F.col("path").cast("array<string>"), "<").alias("path"))


@query(recursive(f"""{DRIFT}, {GRAPH},
links AS (SELECT DISTINCT session_id, src, dst FROM edges WHERE src IS NOT NULL),
walk AS (
  SELECT session_id, symptom_id, symptom_id AS step_id, 0 AS depth FROM shown
  UNION
  SELECT w.session_id, symptom_id, l.src, depth + 1 FROM walk w JOIN links l ON l.session_id = w.session_id AND l.dst = w.step_id)
SELECT session_id, symptom_id, step_id, min(depth)::BIGINT AS depth FROM walk GROUP BY 1, 2, 3"""))
def a4_trace_all(spark, sf_dir):
    """Back to where each session began, by the shortest way."""
    trace = S.event_trace(spark, sf_dir)
    _, edges = B.build_graph(trace)
    return B.trace_back(edges, B.symptoms(trace), None).select("session_id", "symptom_id", "step_id", F.col("depth").cast("bigint").alias("depth"))


@query(recursive(f"""{DRIFT}, {BACK},
way AS (SELECT session_id, symptom_id, step_id, depth, unnest(path) AS node, generate_subscripts(path, 1) AS pos FROM back),
named AS (SELECT w.session_id, symptom_id, w.step_id, depth, pos, t.name,
            lag(t.name) OVER (PARTITION BY w.session_id, symptom_id, w.step_id ORDER BY pos DESC) AS before
          FROM way w JOIN trace t ON t.session_id = w.session_id AND t.step_id = w.node)
SELECT session_id, symptom_id, step_id, depth::BIGINT AS depth, string_agg(name, '>' ORDER BY pos DESC) AS stages
FROM named WHERE before IS NULL OR before <> name GROUP BY session_id, symptom_id, step_id, depth"""))
def a5_propagation(spark, sf_dir):
    trace = store(S.slim(S.event_trace(spark, sf_dir)))
    nodes, _ = B.build_graph(trace)
    return B.propagation(traced(trace), nodes).select(
        "session_id", "symptom_id", "step_id", F.col("depth").cast("bigint").alias("depth"), F.array_join("stages", ">").alias("stages"))


@query(f"""WITH {DRIFT} SELECT session_id, symptom_id, symptom_step, first_step, first_step_id, rule_id FROM critical""")
def a6_critical_step(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return A.critical_step(drift_findings(trace), B.symptoms(trace)).select(
        "session_id", "symptom_id", F.col("symptom_step").cast("bigint").alias("symptom_step"),
        F.col("first_step").cast("bigint").alias("first_step"), "first_step_id", "rule_id")


IMPACT = """
held AS (SELECT DISTINCT session_id, name FROM trace),
impact AS (
  SELECT h.name, count(*) AS n_with, count(*) FILTER (NOT good) AS failed_with,
         (SELECT count(*) FROM outcome) AS n, (SELECT count(*) FILTER (NOT good) FROM outcome) AS failed
  FROM held h JOIN outcome o USING (session_id) GROUP BY h.name),
lift AS (SELECT name, n_with, failed_with, n_with / n AS support, failed_with / n_with AS rate_with,
           (failed - failed_with) / nullif(n - n_with, 0) AS rate_without FROM impact)"""


@query(recursive(f"""{DRIFT}, {BACK}, {IMPACT},
c AS (
  SELECT b.session_id, symptom_id, d.step_id, d.step, depth, d.rule_id,
    round(0.4 / (1 + depth) + 0.3 * d.severity + 0.2 * (symptom_step - d.step) / symptom_step
          + 0.1 * coalesce(rate_with / nullif(rate_with + rate_without, 0), 0), 9) AS score
  FROM back b JOIN drift d ON d.session_id = b.session_id AND d.step_id = b.step_id LEFT JOIN lift l ON l.name = d.stage)
SELECT session_id, symptom_id, step_id, depth::BIGINT AS depth, rule_id, round(score, 6) AS score, place FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id, symptom_id ORDER BY score DESC, step, rule_id) AS place FROM c)
WHERE place <= 3"""))
def a7_candidate_causes(spark, sf_dir):
    trace = store(S.slim(S.event_trace(spark, sf_dir)))
    lift = A.event_impact(trace, S.event_outcome(trace))
    return A.candidate_causes(traced(trace), drift_findings(trace), 3, lift).select(
        "session_id", "symptom_id", "step_id", F.col("depth").cast("bigint").alias("depth"), "rule_id",
        F.round("score", 6).alias("score"), F.col("place").cast("bigint").alias("place"))


def critical_of(trace):
    return settle(A.critical_step(drift_findings(trace), B.symptoms(trace)))


@query(f"WITH {DRIFT} SELECT session_id, symptom_id, gate_step_id, gate_step, gate FROM missed")
def a8_missed_gates(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return A.missed_gates(S.event_gates(trace), critical_of(trace)).withColumn("gate_step", F.col("gate_step").cast("bigint"))


@query(f"""WITH {DRIFT},
spans AS (SELECT session_id, min(first_step) AS b, max(symptom_step) AS e FROM critical GROUP BY 1)
SELECT gate, count(*) AS chances, count(*) FILTER (passed) AS misses, round(count(*) FILTER (passed) / count(*), 6) AS miss_share
FROM gates g JOIN spans s ON s.session_id = g.session_id AND step > b AND step <= e GROUP BY gate""")
def a9_gate_stats(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return A.gate_stats(S.event_gates(trace), critical_of(trace)).withColumn("miss_share", F.round("miss_share", 6))


@query(f"""WITH {DRIFT}, {IMPACT}
SELECT name, n_with, failed_with, round(support, 6) AS support, round(rate_with, 6) AS rate_with, round(rate_without, 6) AS rate_without,
       round(rate_with - rate_without, 6) AS difference, round(rate_with / nullif(rate_without, 0), 6) AS lift FROM lift""")
def a10_event_impact(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    out = A.event_impact(trace, S.event_outcome(trace))
    return out.withColumns({c: F.round(c, 6) for c in ("support", "rate_with", "rate_without", "difference", "lift")})


@query(f"""WITH {TRACE},
back3 AS (SELECT session_id, step_id, name, list(name) OVER (PARTITION BY session_id ORDER BY step ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS b FROM trace)
SELECT session_id, step_id, coalesce(array_to_string(b, '>'), '') AS steps_before FROM back3 WHERE name = 'error'""")
def a11_error_lookback(spark, sf_dir):
    return A.error_lookback(S.event_trace(spark, sf_dir), 3).select(
        "session_id", "step_id", F.array_join(F.transform("before", lambda r: r["name"]), ">").alias("steps_before"))


@query(f"""WITH {TRACE},
c AS (SELECT *, last_value(CASE WHEN layer = 'cognition' THEN step_id END IGNORE NULLS) OVER (
        PARTITION BY session_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS thought_step_id FROM trace)
SELECT session_id, step_id, name, thought_step_id FROM c WHERE kind = 'action'""")
def a12_decision_context(spark, sf_dir):
    return A.decision_context(S.event_trace(spark, sf_dir)).select("session_id", "step_id", "name", "thought_step_id")


VOTES = """
ballots AS (SELECT CAST(d.doc_id AS VARCHAR) AS finding_id, (n_chars < 200)::INT + (quality = 0)::INT + (toxic = 1)::INT AS correct
            FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
votes AS (SELECT finding_id, 3::BIGINT AS n_votes, (3 - correct)::BIGINT AS confirm, correct::BIGINT AS correct,
            CASE WHEN correct = 3 THEN 'correct' WHEN correct = 0 THEN 'confirm' ELSE 'split' END AS decision FROM ballots)"""


@query(f"WITH {VOTES} SELECT finding_id, n_votes, confirm, correct, decision FROM votes")
def a13_vote(spark, sf_dir):
    return A.vote(S.document_votes(spark, sf_dir), 3).select("finding_id", "n_votes", "confirm", "correct", "decision")


def weighed_sql(rounds: int) -> str:
    """The rounds written out one after the other, finding by finding."""
    kinds = K.VERDICTS
    votes = """v AS (SELECT CAST(d.doc_id AS VARCHAR) AS finding_id, u.reviewer, CASE WHEN u.bad THEN 'correct' ELSE 'confirm' END AS verdict
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id,
       LATERAL (VALUES ('length', d.n_chars < 200), ('quality', l.quality = 0), ('toxicity', l.toxic = 1)) u(reviewer, bad)),
p0 AS (SELECT finding_id, """ + ", ".join(f"count(*) FILTER (verdict = '{k}') / count(*) AS s{c}" for c, k in enumerate(kinds)) + " FROM v GROUP BY 1)"
    sums = lambda a: ", ".join(f"sum(p.s{c}) AS {a}{c}" for c in range(3))
    for k in range(rounds):
        votes += f""",
g{k} AS (SELECT reviewer, verdict, {sums('g')} FROM v JOIN p{k} p USING (finding_id) GROUP BY 1, 2),
t{k} AS (SELECT reviewer, {', '.join(f'sum(g{c}) AS t{c}' for c in range(3))} FROM g{k} GROUP BY 1),
r{k} AS (SELECT reviewer, verdict, {', '.join(f'ln((g{c} + 1) / (t{c} + 3)) AS r{c}' for c in range(3))} FROM g{k} JOIN t{k} USING (reviewer)),
o{k} AS (SELECT {', '.join(f'ln((sum(s{c}) + 1) / (count(*) + 3)) AS o{c}' for c in range(3))} FROM p{k}),
l{k} AS (SELECT finding_id, {', '.join(f'sum(r{c}) + any_value(o{c}) AS l{c}' for c in range(3))} FROM v JOIN r{k} USING (reviewer, verdict), o{k} GROUP BY 1),
p{k + 1} AS (SELECT finding_id, {', '.join(f'exp(l{c} - greatest(l0, l1, l2)) / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2))) AS s{c}' for c in range(3))} FROM l{k})"""
    return votes


@query(f"""WITH {weighed_sql(K.ROUNDS)}
SELECT finding_id, 3::BIGINT AS n_votes, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 'confirm' WHEN s1 >= s2 THEN 'correct' ELSE 'insufficient' END AS decision,
       round(greatest(s0, s1, s2), 6) AS probability FROM p{K.ROUNDS}""")
def a13_weighed_votes(spark, sf_dir):
    found, _ = K.weighed_votes(S.document_votes(spark, sf_dir))
    return found.select("finding_id", F.col("n_votes").cast("bigint").alias("n_votes"), "decision", F.round("probability", 6).alias("probability"))


@query(f"""WITH {weighed_sql(K.ROUNDS)},
r AS (SELECT reviewer, verdict, unnest(['confirm', 'correct', 'insufficient']) AS truth, exp(unnest([r0, r1, r2])) AS rate FROM r{K.ROUNDS - 1})
SELECT reviewer, truth, verdict, round(rate, 6) AS rate FROM r""")
def a13_verifier_rates(spark, sf_dir):
    _, rates = K.weighed_votes(S.document_votes(spark, sf_dir))
    return rates.select("reviewer", "truth", "verdict", F.round("rate", 6).alias("rate"))


def session_cases(trace):
    """A case per session: shape of its first deviation, and what came before it as its cause."""
    first = drift_findings(trace).groupBy("session_id").agg(F.min(F.struct("step", "step_id", "rule_kind", "stage")).alias("f"))
    prior = running(trace, {"before": previous("stage")}).select("session_id", "step_id", "before", "version")
    cases = first.select("session_id", "f.step_id", "f.rule_kind", "f.stage").join(prior, ["session_id", "step_id"])
    return cases.select("session_id", "version", signature("rule_kind", "stage").alias("signature"),
                        F.concat(F.lit("after "), F.coalesce("before", F.lit("start"))).alias("cause"))


CASES = """
cases AS (SELECT f.session_id, t.version, sha256(concat(rule_kind, '|', stage)) AS signature, concat('after ', coalesce(t.before, 'start')) AS cause
          FROM firsts f JOIN trace t ON t.session_id = f.session_id AND t.step_id = f.first_step_id)"""


@query(f"""WITH {DRIFT}, {CASES},
earlier AS (SELECT c.session_id, c.signature, p.cause, count(*) AS cases FROM cases c
            JOIN cases p ON p.signature = c.signature AND p.version < c.version AND p.cause <> 'after start' GROUP BY 1, 2, 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY cases DESC, cause) AS place FROM earlier)
SELECT session_id, signature, cause AS past_cause, cases, place FROM placed WHERE place <= 2""")
def a14_recall_cases(spark, sf_dir):
    cases = settle(session_cases(S.event_trace(spark, sf_dir)))
    # Stand-in for what nobody could explain: deviations at the start have no cause yet.
    memory = cases.withColumn("cause", F.when(F.col("cause") != "after start", F.col("cause")))
    return A.recall_cases(cases.select("session_id", "version", "signature"), memory, 2).select(
        "session_id", "signature", F.col("cause").alias("past_cause"), "cases", F.col("place").cast("bigint").alias("place"))


@query("""WITH x AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, m.vec_id AS case_id, concat('cause-', m.label) AS cause, round(list_cosine_similarity(q.v, m.v), 9) AS cosine
      FROM x q JOIN x m ON m.vec_id < q.vec_id AND m.label > 0)
SELECT query_id, case_id, cause, round(cosine, 6) AS cosine, place FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, case_id) AS place FROM s) WHERE place <= 3""")
def a14_recall_near(spark, sf_dir):
    """Past cases are vectors of smaller id with a label above 0, which stands for a confirmed cause."""
    vectors = S.table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("at"), F.col("embedding").alias("vector"))
    memory = vectors.select(F.col("vec_id").alias("case_id"), F.col("vec_id").alias("at"), F.col("embedding").alias("vector"),
                            F.when(F.col("label") > 0, F.concat(F.lit("cause-"), "label")).alias("cause"))
    near = A.recall_near(queries, memory, 3, 64)
    return near.select("query_id", "case_id", "cause", F.round("cosine", 6).alias("cosine"), F.col("place").cast("bigint").alias("place"))


REPORT = recursive(f"""{DRIFT}, {BACK},
c AS (
  SELECT b.session_id, symptom_id, d.step_id, d.step, d.rule_id,
    round(0.4 / (1 + depth) + 0.3 * d.severity + 0.2 * (symptom_step - d.step) / symptom_step, 9) AS score
  FROM back b JOIN drift d ON d.session_id = b.session_id AND d.step_id = b.step_id),
best AS (SELECT session_id, arg_min(rule_id, (-score, step, rule_id, step_id)) AS cause FROM c GROUP BY 1),
n AS (SELECT session_id, count(DISTINCT symptom_id) AS symptoms FROM shown GROUP BY 1),
f AS (SELECT DISTINCT session_id, first_step_id, rule_id FROM critical),
m AS (SELECT session_id, arg_min(gate, (gate_step, gate_step_id)) AS gate FROM missed GROUP BY 1)
SELECT session_id, symptoms, first_step_id, cause, gate,
  concat(session_id, ': ', symptoms, ' symptom(s); first deviation ', coalesce(rule_id, 'none'), '; likely cause ',
         coalesce(cause, 'none'), '; missed gate ', coalesce(gate, 'none')) AS sentence
FROM n LEFT JOIN f USING (session_id) LEFT JOIN best USING (session_id) LEFT JOIN m USING (session_id)""")


def reports(trace):
    findings, shown = store(drift_findings(trace)), settle(B.symptoms(trace))
    critical = settle(A.critical_step(findings, shown))
    _, edges = B.build_graph(trace)
    causes = settle(A.candidate_causes(B.trace_back(edges, shown, DEPTH), findings, 1))
    return A.attribution_report(shown, critical, causes, A.missed_gates(S.event_gates(trace), critical))


@query(REPORT)
def a15_attribution_report(spark, sf_dir):
    return reports(store(S.slim(S.event_trace(spark, sf_dir)))).select(
        "session_id", "symptoms", "first_step_id", "cause", "gate", "sentence")


@query(REPORT)
def io6_write_reports(spark, sf_dir):
    path = scratch(spark, "reports")
    IO.write_reports(conform(reports(store(S.slim(S.event_trace(spark, sf_dir)))), schemas.REPORTS), path)
    return spark.read.schema(schemas.REPORTS).json(path)


@query(f"""WITH {TRACE}
SELECT before, name AS stage, count(*) AS n,
       round(quantile_cont(date_diff('microsecond', ts_before, ts) / 1e6, 0.5), 4) AS median_seconds
FROM trace WHERE before IS NOT NULL GROUP BY 1, 2""")
def a16_flow_view(spark, sf_dir):
    return A.flow_view(S.event_trace(spark, sf_dir)).withColumn("median_seconds", F.round("median_seconds", 4))


@query(f"""WITH {TRACE}
SELECT before, name AS stage, count(*) AS n, round(quantile_cont(date_diff('microsecond', ts_before, ts) / 1e6, 0.5), 4) AS median_seconds
FROM trace WHERE before IS NOT NULL AND version BETWEEN '2024-01-08' AND '2024-01-22' GROUP BY 1, 2""")
def a16_flow_over_versions(spark, sf_dir):
    """Three versions' flow from sketches kept of every version."""
    moves = store(A.flow_moves(S.event_trace(spark, sf_dir)))
    kept, span = store(A.flow_sketches(moves)), F.col("version").between("2024-01-08", "2024-01-22")
    return A.flow_view_over(kept.where(span), moves.where(span)).withColumn("median_seconds", F.round("median_seconds", 4))
