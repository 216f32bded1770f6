"""Registered queries: expert labels, evaluation sets and the release loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions.sizing import settle, store
from driftline.operators import attribution as A
from driftline.operators import claims as V
from driftline.operators import graph as B
from driftline.operators import release as E
from driftline.operators import review as H
from driftline.plans.queries_graph import BACK, CASES, VOTES, critical_of, recursive, session_cases, traced
from driftline.plans.queries_trace import drift_findings
from driftline.plans.registry import DRIFT, TRACE, query
from driftline.sources import bindings as S

# Cause -> what to change.
ROUTING = [("short_text", "Prompt"), ("low_quality", "Skill"), ("toxic_text", "Gate"), ("none", "Workflow")]
ADVICE = [("skipped_step", "add the stage before this step"), ("wrong_order", "keep the order of the workflow")]
ROUTES = ", ".join(f"('{c}', '{t}')" for c, t in ROUTING)
HINTS = ", ".join(f"('{k}', '{a}')" for k, a in ADVICE)
FLOORS = {"pass_rate": 0.5, "mean_score": 40.0}


def verdict_of_symptoms(critical):
    """Stand-in verdicts per symptom: an early deviation is confirmed, a late one insufficient."""
    return critical.select(
        "session_id", "symptom_id", F.when(F.col("first_step") <= 2, F.col("rule_id")).alias("cause"),
        F.when(F.col("first_step") <= 2, "confirm").otherwise("insufficient").alias("verdict"))


def record_table(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    shown, critical = B.symptoms(trace), critical_of(trace)
    nodes, _ = B.build_graph(trace)
    at_symptom = trace.where("not ok").select(*[c for c in ("owner", "session_id", "seg", "step_id", "step") if c in trace.columns])
    evidence = V.attach_evidence(at_symptom, S.event_proofs(trace)).select(
        "session_id", F.col("step_id").alias("symptom_id"), "evidence")
    disposition = F.when(F.col("cause").isNotNull() & F.col("gate").isNotNull(), "fixed").when(
        F.col("cause").isNotNull(), "watch").otherwise("open")
    return H.label_records(shown, critical, nodes, evidence, verdict_of_symptoms(critical),
                           A.missed_gates(S.event_gates(trace), critical), disposition)


RECORDS = """
refs AS (SELECT session_id, step_id, array_to_string(list_transform(list_sort(list_filter([
      {'s': last_value(CASE WHEN name = 'click' THEN step_id END IGNORE NULLS) OVER w, 'k': 'trace'},
      {'s': last_value(CASE WHEN name = 'view' THEN step_id END IGNORE NULLS) OVER w, 'k': 'command'},
      {'s': last_value(CASE WHEN name = 'signup' THEN step_id END IGNORE NULLS) OVER w, 'k': 'diff'}],
      lambda x: x.s IS NOT NULL)), lambda x: concat(x.s, ':', x.k)), ',') AS refs
  FROM trace WINDOW w AS (PARTITION BY session_id ORDER BY step ROWS UNBOUNDED PRECEDING)),
records AS (
  SELECT s.session_id, s.symptom_id, s.symptom_step, c.stage AS violated_stage, c.rule_id AS violated, c.first_step_id AS action_step,
    t.kind AS action_kind, r.refs, CASE WHEN c.first_step <= 2 THEN c.rule_id END AS cause, m.gate,
    CASE WHEN c.first_step <= 2 AND m.gate IS NOT NULL THEN 'fixed' WHEN c.first_step <= 2 THEN 'watch' ELSE 'open' END AS disposition
  FROM shown s LEFT JOIN critical c ON c.session_id = s.session_id AND c.symptom_id = s.symptom_id
  LEFT JOIN trace t ON t.session_id = c.session_id AND t.step_id = c.first_step_id
  LEFT JOIN refs r ON r.session_id = s.session_id AND r.step_id = s.symptom_id
  LEFT JOIN missed m ON m.session_id = s.session_id AND m.symptom_id = s.symptom_id)"""


@query(f"WITH {DRIFT}, {RECORDS} SELECT * FROM records")
def h1_label_records(spark, sf_dir):
    return record_table(spark, sf_dir).select(
        "session_id", "symptom_id", F.col("symptom.step").cast("bigint").alias("symptom_step"),
        F.col("violated.stage").alias("violated_stage"), F.col("violated.constraint").alias("violated"),
        F.col("key_action.step_id").alias("action_step"), F.col("key_action.kind").alias("action_kind"),
        F.array_join(F.transform("evidence", lambda e: F.concat_ws(":", e["step_id"].cast("string"), e["kind"])), ",").alias("refs"), F.col("confirmed_cause").alias("cause"),
        F.col("stopping_gate").alias("gate"), "disposition")


RESOLVED = """
auto AS (SELECT CAST(doc_id AS VARCHAR) AS finding_id, source AS stratum, n_chars < 200 AS flagged,
           CASE WHEN n_chars < 200 THEN 'short_text' ELSE 'none' END AS auto_cause, n_chars / (n_chars + 400.0) AS score FROM documents),
latest AS (SELECT CAST(doc_id AS VARCHAR) AS finding_id,
             CASE WHEN quality = 0 THEN 'correct' WHEN toxic = 1 THEN 'insufficient' ELSE 'confirm' END AS verdict,
             CASE WHEN quality = 0 AND toxic = 1 THEN 'toxic_text' WHEN quality = 0 THEN 'low_quality' END AS expert_cause,
             CASE WHEN toxic = 1 THEN 2 ELSE 1 END AS n_verdicts FROM labels),
resolved AS (SELECT a.*, coalesce(verdict, 'unreviewed') AS verdict, coalesce(n_verdicts, 0)::BIGINT AS n_verdicts,
               CASE verdict WHEN 'insufficient' THEN NULL WHEN 'correct' THEN expert_cause ELSE auto_cause END AS cause
             FROM auto a LEFT JOIN latest l USING (finding_id))"""


def resolved_documents(spark, sf_dir):
    return H.resolve(S.document_auto(spark, sf_dir), S.document_verdicts(spark, sf_dir), ["finding_id"], ["round"])


@query(f"WITH {RESOLVED} SELECT finding_id, auto_cause, cause, verdict, n_verdicts FROM resolved")
def h2_resolve(spark, sf_dir):
    return resolved_documents(spark, sf_dir).select("finding_id", "auto_cause", "cause", "verdict", "n_verdicts")


@query(f"""WITH {RESOLVED} SELECT stratum, finding_id, place FROM (
SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY abs(score - 0.5), finding_id) AS place FROM auto) WHERE place <= 5""")
def h3_review_queue(spark, sf_dir):
    return H.review_queue(S.document_auto(spark, sf_dir), 5).select(
        "stratum", "finding_id", F.col("place").cast("bigint").alias("place"))


@query("""WITH d AS (SELECT n_chars < 200 AS f, quality = 0 AS b, l.doc_id IS NOT NULL AS labelled FROM documents FULL JOIN labels l USING (doc_id)),
c AS (SELECT count(*) FILTER (f AND b) AS tp, count(*) FILTER (f AND NOT b) AS fp, count(*) FILTER (NOT f AND b) AS fn,
        count(*) FILTER (NOT f AND NOT b) AS tn, count(*) FILTER (labelled AND b IS NULL) AS insufficient,
        count(*) FILTER (NOT labelled) AS unreviewed FROM d)
SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall FROM c""")
def h4_label_accuracy(spark, sf_dir):
    labels = S.table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("finding_id"), (F.col("quality") == 0).alias("bad"))
    out = H.label_accuracy(S.document_auto(spark, sf_dir), labels, "finding_id")
    return out.withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


@query(recursive(f"""{DRIFT}, {BACK},
c AS (SELECT b.session_id, symptom_id, d.step_id, row_number() OVER (PARTITION BY b.session_id, symptom_id ORDER BY
    round(0.4 / (1 + depth) + 0.3 * d.severity + 0.2 * (symptom_step - d.step) / symptom_step, 9) DESC, d.step, d.rule_id) AS place
  FROM back b JOIN drift d ON d.session_id = b.session_id AND d.step_id = b.step_id),
hit AS (SELECT t.session_id, t.symptom_id, min(place) AS place FROM critical t LEFT JOIN c
        ON c.session_id = t.session_id AND c.symptom_id = t.symptom_id AND c.step_id = t.first_step_id AND c.place <= 5 GROUP BY 1, 2)
SELECT k, count(*) AS n, count(*) FILTER (place <= k) AS hits, round(count(*) FILTER (place <= k) / count(*), 6) AS rate
FROM hit, (SELECT unnest([1, 3, 5])::BIGINT AS k) GROUP BY k"""))
def h4_step_hits(spark, sf_dir):
    trace = store(S.slim(S.event_trace(spark, sf_dir)))
    findings = store(drift_findings(trace))
    causes = A.candidate_causes(traced(trace), findings, 5)
    truth = settle(A.critical_step(findings, B.symptoms(trace))).withColumn("step_id", F.col("first_step_id"))
    out = H.step_hits(causes, truth, [1, 3, 5])
    return out.select(F.col("k").cast("bigint").alias("k"), "n", "hits", F.round("rate", 6).alias("rate"))


@query(f"""WITH {DRIFT}, {RECORDS}
SELECT cause, gate, grouping(cause, gate)::BIGINT AS level, count(*) AS n, count(*) FILTER (disposition = 'fixed') AS fixed
FROM records GROUP BY CUBE (cause, gate)""")
def h5_dispositions(spark, sf_dir):
    labels = record_table(spark, sf_dir).select(
        F.col("confirmed_cause").alias("cause"), F.col("stopping_gate").alias("gate"), "disposition")
    return H.dispositions(labels)


@query(f"""WITH {DRIFT}, {CASES}
SELECT signature, min(session_id) AS case_id, arg_min(cause, session_id) AS cause, count(*) AS stands_for FROM cases GROUP BY signature""")
def e1_curate(spark, sf_dir):
    cases = session_cases(S.event_trace(spark, sf_dir)).drop("version")
    return E.curate(cases.withColumnRenamed("session_id", "case_id"))


@query(f"""WITH {RESOLVED}, {VOTES}
SELECT r.finding_id, verdict = 'correct' AND cause IS DISTINCT FROM auto_cause AS disagrees, coalesce(decision = 'split', false) AS split
FROM resolved r LEFT JOIN votes v USING (finding_id)
WHERE (verdict = 'correct' AND cause IS DISTINCT FROM auto_cause) OR decision = 'split'""")
def e2_hard_cases(spark, sf_dir):
    return hard_documents(spark, sf_dir).select("finding_id", "disagrees", "split")


def hard_documents(spark, sf_dir):
    return E.hard_cases(resolved_documents(spark, sf_dir), A.vote(S.document_votes(spark, sf_dir), 3))


@query(f"""WITH {RESOLVED}, {VOTES},
hard AS (SELECT r.finding_id FROM resolved r LEFT JOIN votes v USING (finding_id)
         WHERE (verdict = 'correct' AND cause IS DISTINCT FROM auto_cause) OR decision = 'split')
SELECT finding_id AS case_id, CASE WHEN finding_id IN (SELECT finding_id FROM hard) THEN 'hard' ELSE 'golden' END AS set_name,
  CASE WHEN CAST(finding_id AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM resolved""")
def e3_assign_sets(spark, sf_dir):
    cases = resolved_documents(spark, sf_dir).select(F.col("finding_id").alias("case_id"))
    hard = hard_documents(spark, sf_dir).select(F.col("finding_id").alias("case_id"))
    return E.assign_sets(cases, hard, number=F.col("case_id").cast("bigint"))


RESULTS = """
results AS (SELECT CAST(user_id AS VARCHAR) AS case_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS version,
              avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) <= 0.2 AS passed, avg(value) AS score FROM events GROUP BY 1, 2),
base AS (SELECT * FROM results WHERE version = '2024-01-08'),
cand AS (SELECT * FROM results WHERE version = '2024-01-15'),
paired AS (SELECT b.case_id AS b_id, c.case_id AS c_id, b.passed AS was, c.passed AS now, c.score, b.score AS b_score
           FROM base b FULL JOIN cand c ON b.case_id = c.case_id)"""


def two_rounds(spark, sf_dir):
    results = S.event_results(spark, sf_dir)
    return results.where("version = '2024-01-08'"), results.where("version = '2024-01-15'")


def error_prone_cases(spark, sf_dir):
    """Users as cases; hard are those with more than a fifth of errors over all weeks."""
    users = S.event_results(spark, sf_dir).groupBy("case_id").agg(F.count_if(~F.col("passed")).alias("failed"), F.count("*").alias("n"))
    hard = users.where(F.col("failed") * 2 > F.col("n"))
    return E.assign_sets(users.select("case_id"), hard, number=F.col("case_id").cast("bigint"))


@query(f"""WITH {RESULTS},
sets AS (SELECT case_id, CASE WHEN count(*) FILTER (NOT passed) * 2 > count(*) THEN 'hard' ELSE 'golden' END AS set_name FROM results GROUP BY 1)
SELECT set_name, version, grouping(set_name, version)::BIGINT AS level, count(*) AS n,
  round(avg(passed::INT), 6) AS pass_rate, round(avg(score), 6) AS mean_score
FROM results JOIN sets USING (case_id) GROUP BY GROUPING SETS ((set_name, version), (version), ())""")
def e4_offline_eval(spark, sf_dir):
    out = E.offline_eval(S.event_results(spark, sf_dir), error_prone_cases(spark, sf_dir))
    return out.withColumns({"pass_rate": F.round("pass_rate", 6), "mean_score": F.round("mean_score", 6)})


GATE = """
gate AS (SELECT avg(now::INT) AS pass_rate, avg(score) AS mean_score, count(*) FILTER (was AND NOT coalesce(now, false)) AS regressions,
           count(*) FILTER (c_id IS NULL) AS not_run FROM paired)"""


@query(f"""WITH {RESULTS}, {GATE}
SELECT round(pass_rate, 6) AS pass_rate, round(mean_score, 6) AS mean_score, regressions, not_run,
  pass_rate >= 0.5 AND mean_score >= 40 AS floors_met, pass_rate >= 0.5 AND mean_score >= 40 AND regressions = 0 AS accepted FROM gate""")
def e5_release_gate(spark, sf_dir):
    out = E.release_gate(*two_rounds(spark, sf_dir), FLOORS)
    return out.withColumns({"pass_rate": F.round("pass_rate", 6), "mean_score": F.round("mean_score", 6)})


@query(f"""WITH {RESULTS},
kept AS (SELECT b_id, c_id, was, CASE WHEN score <= 50 THEN now END AS now FROM paired)
SELECT count(*) FILTER (was AND NOT coalesce(now, false)) AS regressions, count(*) FILTER (c_id IS NULL) AS not_run,
  count(*) FILTER (was AND NOT coalesce(now, false)) = 0 AND avg(now::INT) >= 0 AS accepted FROM kept""")
def e5_release_gate_undecided(spark, sf_dir):
    """Costly cases of the candidate are left undecided; those passed before block it."""
    base, cand = two_rounds(spark, sf_dir)
    cand = cand.withColumn("passed", F.when(F.col("score") <= 50, F.col("passed")))
    return E.release_gate(base, cand, {"pass_rate": 0.0}).select("regressions", "not_run", "accepted")


@query(f"""WITH {RESULTS}
SELECT coalesce(b_id, c_id) AS case_id, CASE WHEN b_id IS NULL THEN 'new' WHEN c_id IS NULL THEN 'gone'
  WHEN was AND NOT now THEN 'regressed' ELSE 'fixed' END AS change
FROM paired WHERE b_id IS NULL OR c_id IS NULL OR was <> now""")
def e6_case_diff(spark, sf_dir):
    return E.case_diff(*two_rounds(spark, sf_dir))


@query(f"""WITH {RESULTS},
open_ AS (SELECT b_id, c_id, CASE WHEN b_score % 7 < 5 THEN was END AS was, CASE WHEN score <= 50 THEN now END AS now FROM paired)
SELECT coalesce(b_id, c_id) AS case_id, CASE WHEN b_id IS NULL THEN 'new' WHEN c_id IS NULL THEN 'gone' WHEN was AND NOT now THEN 'regressed'
  WHEN NOT was AND now THEN 'fixed' WHEN was THEN 'undecided' WHEN NOT was THEN 'reopened' ELSE 'settled' END AS change
FROM open_ WHERE b_id IS NULL OR c_id IS NULL OR was IS DISTINCT FROM now""")
def e6_case_diff_undecided(spark, sf_dir):
    """Both versions leave some cases open."""
    base, cand = two_rounds(spark, sf_dir)
    return E.case_diff(base.withColumn("passed", F.when(F.col("score") % 7 < 5, F.col("passed"))),
                       cand.withColumn("passed", F.when(F.col("score") <= 50, F.col("passed"))))


@query(f"""WITH {RESULTS},
rates AS (SELECT version, avg(passed::INT) AS pass_rate, avg(score) AS score FROM results GROUP BY 1)
SELECT version, round(pass_rate, 6) AS pass_rate FROM rates WHERE pass_rate >= 0.5 AND score >= 40""")
def e7_accepted(spark, sf_dir):
    rates = S.event_results(spark, sf_dir).groupBy("version").agg(
        F.avg(F.col("passed").cast("double")).alias("pass_rate"), F.avg("score").alias("score"))
    gate = rates.select("version", "pass_rate", (F.col("pass_rate") >= 0.5).alias("accepted"))
    ledger = rates.select("version", F.when(F.col("score") >= 40, "accept").otherwise("reject").alias("decision"))
    return E.accepted(gate, ledger).select("version", F.round("pass_rate", 6).alias("pass_rate"))


@query(f"""WITH {RESULTS},
m AS (SELECT 'pass_rate' AS metric, version, avg(passed::INT) AS value FROM results GROUP BY version
      UNION ALL SELECT 'mean_score', version, avg(score) FROM results GROUP BY version)
SELECT metric, version, round(value, 6) AS value, round(lag(value) OVER w, 6) AS before, round(value - lag(value) OVER w, 6) AS change
FROM m WINDOW w AS (PARTITION BY metric ORDER BY version)""")
def e8_round_trend(spark, sf_dir):
    rates = S.event_results(spark, sf_dir).groupBy("version").agg(
        F.avg(F.col("passed").cast("double")).alias("pass_rate"), F.avg("score").alias("mean_score"))
    metrics = rates.unpivot(["version"], ["pass_rate", "mean_score"], "metric", "value")
    return E.round_trend(metrics).withColumns({c: F.round(c, 6) for c in ("value", "before", "change")})


@query(f"""WITH {RESOLVED}, routes(cause, target) AS (VALUES {ROUTES})
SELECT coalesce(target, 'unrouted') AS target, count(*) AS n, count(DISTINCT coalesce(r.cause, '')) AS causes
FROM resolved r LEFT JOIN routes USING (cause) GROUP BY 1""")
def e9_route_fix(spark, sf_dir):
    routing = spark.createDataFrame(ROUTING, "cause string, target string")
    return E.route_fix(resolved_documents(spark, sf_dir), routing)


@query(f"""WITH {DRIFT}, hints(rule_kind, advice) AS (VALUES {HINTS})
SELECT session_id, step_id, rule_id, advice FROM drift JOIN hints USING (rule_kind)""")
def e10_suggest(spark, sf_dir):
    advice = spark.createDataFrame(ADVICE, "rule_kind string, advice string")
    return E.suggest(drift_findings(S.event_trace(spark, sf_dir)), advice).select("session_id", "step_id", "rule_id", "advice")


ASSERTIONS = {
    "starts with signup": "first_name = 'signup'",
    "has no error": "errors = 0",
    "buys after a click": "first_purchase > first_click",
}


@query(f"""WITH {TRACE},
s AS (SELECT session_id, arg_min(name, step) AS first_name, count(*) FILTER (name = 'error') AS errors,
        min(step) FILTER (name = 'purchase') AS fp, min(step) FILTER (name = 'click') AS fc FROM trace GROUP BY 1),
a AS (SELECT 'starts with signup' AS assertion, first_name = 'signup' AS r FROM s
      UNION ALL SELECT 'has no error', errors = 0 FROM s UNION ALL SELECT 'buys after a click', fp > fc FROM s)
SELECT assertion, count(*) FILTER (r) AS passed, count(*) FILTER (NOT r) AS failed, count(*) FILTER (r IS NULL) AS undecided FROM a GROUP BY 1""")
def e11_assertions(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    sessions = trace.groupBy("owner", "session_id").agg(
        F.min_by("name", "step").alias("first_name"), F.count_if(~F.col("ok")).alias("errors"),
        F.min(F.when(F.col("name") == "purchase", F.col("step"))).alias("first_purchase"),
        F.min(F.when(F.col("name") == "click", F.col("step"))).alias("first_click"))
    return E.assertions(sessions, ASSERTIONS)


@query(f"""WITH {DRIFT},
s AS (SELECT t.session_id, arg_min(version, step) AS version, arg_min(name, step) = 'signup' AS h1,
        coalesce(bool_or(name = 'view' AND step <= 2), false) AS h2, any_value(good)::INT AS good
      FROM trace t JOIN outcome o USING (session_id) GROUP BY 1),
runs AS (SELECT 'signup first' AS hypothesis, version, h1 AS arm, good FROM s UNION ALL SELECT 'early view', version, h2, good FROM s),
g AS (SELECT hypothesis, version, count(*) FILTER (arm) AS n1, count(*) FILTER (NOT arm) AS n0,
        avg(good) FILTER (arm) AS r1, avg(good) FILTER (NOT arm) AS r0 FROM runs GROUP BY 1, 2)
SELECT hypothesis, sum(n1)::BIGINT AS n_with, sum(n0)::BIGINT AS n_without, count(*) FILTER (n1 = 0 OR n0 = 0) AS unmatched_groups,
  round(sum(n1 * (r1 - r0)) / sum(n1) FILTER (n0 > 0), 6) AS effect FROM g GROUP BY 1""")
def e12_intervention_effect(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    sessions = trace.groupBy("session_id").agg(
        F.min_by("version", "step").alias("version"), F.min_by("name", "step").alias("first_name"),
        F.max((F.col("name") == "view") & (F.col("step") <= 2)).alias("early"))
    arms = F.array(*[F.struct(F.lit(n).alias("hypothesis"), F.when(c, "with").otherwise("without").alias("arm"))
                     for n, c in (("signup first", F.col("first_name") == "signup"), ("early view", F.col("early")))])
    runs = sessions.join(S.event_outcome(trace), "session_id").select("version", "good", F.inline(arms))
    return E.intervention_effect(runs, ["version"]).withColumn("effect", F.round("effect", 6))
