"""Registered queries: mined rules and conformance checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions.sizing import settle, store
from driftline.operators import checks as C
from driftline.operators import conformance as W
from driftline.operators import normalize as N
from driftline.operators import paths as D
from driftline.operators import spec as P
from driftline.plans.registry import DRIFT, TRACE, query
from driftline.sources import bindings as S

THETA = 0.5


def held_state_trace(spark, sf_dir):
    """Event trace whose state lacks the amount in rows above the limit."""
    return S.event_trace(spark, sf_dir, state=S.AMOUNT_STATE)


def shown(findings):
    """Findings in the columns the SQL gives."""
    return findings.select("session_id", "step_id", F.col("step").cast("bigint").alias("step"), "stage", "rule_id", "severity")


FIELDS = """
f AS (
  SELECT name AS stage, 'k' AS field, count(*) AS held FROM trace GROUP BY name
  UNION ALL SELECT name, 'amount', count(*) FILTER (value <= 100) FROM trace GROUP BY name),
total AS (SELECT name AS stage, count(*) AS n FROM trace GROUP BY name),
required AS (SELECT stage, field, held / n AS support FROM f JOIN total USING (stage))"""

FIRSTS = """
visits AS (SELECT session_id, name AS stage, min(step) AS at FROM trace GROUP BY 1, 2),
pairs AS (
  SELECT a.stage AS before, b.stage AS stage, count(*) AS n_both, count(*) FILTER (a.at < b.at) / count(*) AS support
  FROM visits a JOIN visits b ON a.session_id = b.session_id AND a.stage <> b.stage GROUP BY 1, 2)"""

MOVES = """
moves AS (SELECT before, name AS stage, count(*) AS n FROM trace WHERE before IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT before, stage, n, n / sum(n) OVER (PARTITION BY before) AS support FROM moves)"""

RANGES = """
r AS (SELECT name AS stage, quantile_cont(value, [0.05, 0.95]) AS q FROM trace GROUP BY 1),
ranges AS (SELECT stage, q[1] AS lo, q[2] AS hi FROM r)"""

STAGES = """
mandatory AS (
  SELECT name AS stage, count(DISTINCT session_id) / (SELECT count(DISTINCT session_id) FROM trace) AS support
  FROM trace GROUP BY name)"""


@query(f"""WITH {TRACE}, {FIELDS}, {FIRSTS}, {MOVES}, {RANGES}, {STAGES}
SELECT concat('required_field::', stage, ':', field) AS rule_id, 'required_field' AS rule_kind, stage,
       round(support, 6) AS support FROM required WHERE support >= {THETA}
UNION ALL SELECT concat('precedence:', before, ':', stage, ':'), 'precedence', stage, round(support, 6) FROM pairs WHERE support >= {THETA}
UNION ALL SELECT concat('range::', stage, ':'), 'range', stage, 0.9::DOUBLE FROM ranges
UNION ALL SELECT concat('transition:', before, ':', stage, ':'), 'transition', stage, round(support, 6) FROM shares WHERE support >= {THETA}
UNION ALL SELECT concat('mandatory_stage::', stage, ':'), 'mandatory_stage', stage, round(support, 6) FROM mandatory WHERE support >= {THETA}""")
def p1_extract_spec(spark, sf_dir):
    spec = P.extract_spec(store(held_state_trace(spark, sf_dir)), THETA)
    return spec.select("rule_id", "rule_kind", "stage", F.round("support", 6).alias("support"))


@query(f"""WITH {TRACE}, {FIELDS} SELECT stage, field, round(support, 6) AS support FROM required WHERE support >= 0.9""")
def p2_mine_fields(spark, sf_dir):
    rows = S.event_rows(spark, sf_dir, state=S.AMOUNT_STATE)
    return P.mine_fields(rows, 0.9).select("stage", "field", F.round("support", 6).alias("support"))


@query(f"""WITH {TRACE}, {FIRSTS} SELECT before, stage, round(support, 6) AS support FROM pairs WHERE support >= {THETA}""")
def p3_mine_order(spark, sf_dir):
    return P.mine_order(S.event_trace(spark, sf_dir), THETA).select("before", "stage", F.round("support", 6).alias("support"))


@query("""WITH r AS (SELECT event_type AS stage, quantile_cont(value, [0.05, 0.95]) AS q FROM events GROUP BY 1)
SELECT stage, round(q[1], 6) AS lo, round(q[2], 6) AS hi FROM r""")
def p4_mine_ranges(spark, sf_dir):
    return P.mine_ranges(S.event_rows(spark, sf_dir), 0.05, 0.95).select(
        "stage", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(f"""WITH {TRACE}, {MOVES} SELECT before, stage, round(support, 6) AS support FROM shares WHERE support >= 0.2""")
def p5_mine_transitions(spark, sf_dir):
    return P.mine_transitions(S.event_trace(spark, sf_dir), 0.2).select("before", "stage", F.round("support", 6).alias("support"))


@query(f"""WITH {TRACE}, {STAGES} SELECT stage, round(support, 6) AS support FROM mandatory WHERE support >= {THETA}""")
def p6_mine_stages(spark, sf_dir):
    return P.mine_stages(S.event_trace(spark, sf_dir), THETA).select("stage", F.round("support", 6).alias("support"))


MISSING_FIELDS = """
SELECT session_id, step_id, step, name AS stage, concat('missing_field:', name, ':amount') AS rule_id, 0.4::DOUBLE AS severity
FROM trace JOIN required r ON r.stage = trace.name AND r.field = 'amount' AND r.support >= 0.5 WHERE NOT value <= 100"""


@query(f"WITH {TRACE}, {FIELDS} {MISSING_FIELDS}")
def c1_missing_fields(spark, sf_dir):
    trace = held_state_trace(spark, sf_dir)
    spec = settle(P.mine_fields(trace, THETA))
    return shown(C.missing_fields(trace, spec))


BAD_UPDATES = """
SELECT session_id, step_id, step, name AS stage, 'monotone_fell:k' AS rule_id, 0.5::DOUBLE AS severity FROM (
  SELECT *, lag(k) OVER (PARTITION BY session_id ORDER BY step) AS k_before FROM trace)
WHERE CAST(k AS DOUBLE) < CAST(k_before AS DOUBLE)"""


@query(f"WITH {TRACE} {BAD_UPDATES}")
def c2_bad_updates(spark, sf_dir):
    return shown(C.bad_updates(S.event_trace(spark, sf_dir), {"k": "monotone"}))


@query(f"""WITH {TRACE},
wanted AS (SELECT unnest(['signup', 'view', 'click', 'purchase']) AS stage),
s AS (SELECT DISTINCT session_id FROM trace)
SELECT session_id, stage, concat('missing_stage:', stage) AS rule_id FROM s, wanted
WHERE (session_id, stage) NOT IN (SELECT (session_id, name) FROM trace)""")
def c3_missing_stages(spark, sf_dir):
    return C.missing_stages(S.event_trace(spark, sf_dir), S.EXPECTED).select("session_id", "stage", "rule_id")


@query(f"""WITH {DRIFT} SELECT session_id, step_id, step, stage, rule_id, severity FROM drift WHERE rule_kind = 'skipped_step'""")
def c4_skipped_steps(spark, sf_dir):
    return shown(C.skipped_steps(S.event_trace(spark, sf_dir), S.ORDINALS))


@query(f"""WITH {DRIFT} SELECT session_id, step_id, step, stage, rule_id, severity FROM drift WHERE rule_kind = 'wrong_order'""")
def c5_order_violations(spark, sf_dir):
    return shown(C.order_violations(S.event_trace(spark, sf_dir), S.ORDINALS))


PRECEDENCE = """
SELECT b.session_id, t.step_id, b.at AS step, b.stage, concat('precedence:', p.before, ':', p.stage) AS rule_id, 0.3::DOUBLE AS severity
FROM pairs p JOIN visits a ON a.stage = p.before JOIN visits b ON b.stage = p.stage AND a.session_id = b.session_id
JOIN trace t ON t.session_id = b.session_id AND t.step = b.at
WHERE p.support >= 0.5 AND a.at > b.at"""


@query(f"WITH {TRACE}, {FIRSTS} {PRECEDENCE}")
def c5_precedence(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return shown(C.precedence_violations(trace, settle(P.mine_order(trace, THETA))))


OUT_OF_RANGE = """
SELECT session_id, step_id, step, name AS stage, concat('out_of_range:', name) AS rule_id, 0.2::DOUBLE AS severity
FROM trace JOIN ranges r ON r.stage = trace.name WHERE value < lo OR value > hi"""


@query(f"WITH {TRACE}, {RANGES} {OUT_OF_RANGE}")
def c6_state_violations(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return shown(C.state_violations(trace, settle(P.mine_ranges(trace, 0.05, 0.95))))


PROTOCOL = """
SELECT session_id, step_id, step, name AS stage, concat('protocol:', before, ':', name) AS rule_id, 0.2::DOUBLE AS severity
FROM trace WHERE before IN (SELECT before FROM shares WHERE support >= 0.2)
AND (before, name) NOT IN (SELECT (before, stage) FROM shares WHERE support >= 0.2)"""


@query(f"WITH {TRACE}, {MOVES} {PROTOCOL}")
def c7_protocol_violations(spark, sf_dir):
    trace = S.event_trace(spark, sf_dir)
    return shown(C.protocol_violations(trace, settle(P.mine_transitions(trace, 0.2))))


BAD_TYPE = """
SELECT session_id, step_id, step, name AS stage, 'bad_type:k' AS rule_id, 0.4::DOUBLE AS severity
FROM trace WHERE TRY_CAST(k AS BOOLEAN) IS NULL"""


@query(f"WITH {TRACE} {BAD_TYPE}")
def c8_schema_violations(spark, sf_dir):
    return shown(C.schema_violations(S.event_trace(spark, sf_dir), {"k": "boolean"}))


@query(f"""WITH {DRIFT}, {FIELDS}, {FIRSTS}, {MOVES}, {RANGES}, {STAGES},
every AS (
  {MISSING_FIELDS}
  UNION ALL {BAD_UPDATES}
  UNION ALL SELECT session_id, step_id, step, stage, rule_id, severity FROM drift
  UNION ALL {PRECEDENCE}
  UNION ALL {OUT_OF_RANGE}
  UNION ALL SELECT session_id, step_id, step, name, concat('protocol:', before, ':', name), 0.2::DOUBLE FROM trace
    WHERE before IN (SELECT before FROM shares WHERE support >= 0.5) AND (before, name) NOT IN (SELECT (before, stage) FROM shares WHERE support >= 0.5)
  UNION ALL {BAD_TYPE}
  UNION ALL SELECT session_id, NULL, NULL, stage, concat('missing_stage:', stage), 0.5::DOUBLE
    FROM (SELECT DISTINCT session_id FROM trace), (SELECT stage FROM mandatory WHERE support >= 0.5)
    WHERE (session_id, stage) NOT IN (SELECT (session_id, name) FROM trace))
SELECT session_id, rule_id, count(*) AS n, round(sum(severity), 6) AS severity,
       min(step) AS first_step FROM every GROUP BY session_id, rule_id""")
def c9_debug(spark, sf_dir):
    trace = store(held_state_trace(spark, sf_dir))
    spec = settle(P.extract_spec(trace, THETA))
    found = C.debug_windows(trace, spec, S.ORDINALS, {"k": "monotone"}, {"k": "boolean"})
    return found.groupBy("session_id", "rule_id").agg(
        F.count("*").alias("n"), F.round(F.sum("severity"), 6).alias("severity"),
        F.min("step").cast("bigint").alias("first_step"))


# Two skills with rules of their own for one stage, and rules for all; columns of the spec table without support.
SKILL_RULES = [
    ("cheap", "a", "range", "click", None, None, 5.0, 100.0), ("dear", "b", "range", "click", None, None, 150.0, 200.0),
    (None, "c", "range", "view", None, None, 10.0, 300.0), ("cheap", "d", "required_field", "view", None, "note", None, None),
    (None, "e", "required_field", "click", None, "k", None, None), ("dear", "f", "mandatory_stage", "purchase", None, None, None, None),
    (None, "g", "mandatory_stage", "view", None, None, None, None), ("cheap", "h", "precedence", "click", "view", None, None, None),
    ("dear", "i", "precedence", "view", "click", None, None, None)]


@query(f"""WITH {TRACE},
t AS (SELECT *, CASE WHEN value <= 100 THEN 'cheap' ELSE 'dear' END AS skill FROM trace),
v AS (SELECT session_id, skill, name, min(step) AS at FROM t GROUP BY 1, 2, 3)
SELECT session_id, step, concat('out_of_range:', name) AS rule_id, skill FROM t
WHERE (name = 'click' AND skill = 'cheap' AND (value < 5 OR value > 100)) OR (name = 'click' AND skill = 'dear' AND (value < 150 OR value > 200))
   OR (name = 'view' AND (value < 10 OR value > 300))
UNION ALL SELECT session_id, step, 'missing_field:view:note', skill FROM t WHERE name = 'view' AND skill = 'cheap'
UNION ALL SELECT session_id, step, 'missing_field:click:k', skill FROM t WHERE name = 'click' AND k IS NULL
UNION ALL SELECT session_id, NULL, 'missing_stage:view', NULL FROM t GROUP BY session_id HAVING count(*) FILTER (name = 'view') = 0
UNION ALL SELECT session_id, NULL, 'missing_stage:purchase', NULL FROM t GROUP BY session_id
  HAVING count(*) FILTER (name = 'purchase') = 0 AND count(*) FILTER (skill = 'dear') > 0
UNION ALL SELECT a.session_id, a.at, concat('precedence:', b.name, ':', a.name), a.skill FROM v a JOIN v b USING (session_id, skill)
WHERE b.at > a.at AND ((skill = 'cheap' AND a.name = 'click' AND b.name = 'view') OR (skill = 'dear' AND a.name = 'view' AND b.name = 'click'))""")
def c9_skill_rules(spark, sf_dir):
    """Rules of two skills for one stage; each is asked of its own rows."""
    trace = store(S.event_trace(spark, sf_dir).withColumn("skill", F.when(F.col("value") <= 100, "cheap").otherwise("dear")))
    spec = spark.createDataFrame(SKILL_RULES, "skill string, rule_id string, rule_kind string, stage string, before string, field string, lo double, hi double")
    found = C.missing_fields(trace, spec).unionByName(C.state_violations(trace, spec))
    found = found.unionByName(C.missing_stages(trace, spec)).unionByName(C.precedence_violations(trace, spec))
    return found.select("session_id", F.col("step").cast("bigint").alias("step"), "rule_id", "skill")


# Transition rules of one skill out of two of its stages, and for all out of a third.
WAYS = [("cheap", "a", "transition", "click", "view"), ("cheap", "b", "transition", "error", "view"), ("cheap", "c", "transition", "signup", "signup"),
        (None, "d", "transition", "purchase", "click")]


@query(f"""WITH {TRACE}, t AS (SELECT *, CASE WHEN value <= 100 THEN 'cheap' ELSE 'dear' END AS skill FROM trace)
SELECT session_id, step_id, skill, concat('protocol:', before, ':', name) AS rule_id FROM t
WHERE (skill = 'cheap' AND before = 'view' AND name NOT IN ('click', 'error')) OR (skill = 'cheap' AND before = 'signup' AND name <> 'signup')
   OR (before = 'click' AND name <> 'purchase')""")
def c7_skill_ways(spark, sf_dir):
    """Moves are asked only where their skill, or all, have a rule for them."""
    trace = S.event_trace(spark, sf_dir).withColumn("skill", F.when(F.col("value") <= 100, "cheap").otherwise("dear"))
    rules = spark.createDataFrame([(*w, None, None, None) for w in WAYS], "skill string, rule_id string, rule_kind string, stage string, before string, field string, lo double, hi double")
    return C.protocol_violations(trace, rules).select("session_id", "step_id", "skill", "rule_id")


@query(f"""WITH {TRACE},
cut AS (SELECT *, max(ord) OVER w AS peak_here, lag(name) OVER (PARTITION BY session_id, signups ORDER BY step) AS before_here
        FROM trace WHERE signups > 0
        WINDOW w AS (PARTITION BY session_id, signups ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
moves AS (SELECT before_here AS before, name AS stage, count(*) AS n FROM cut WHERE before_here IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT before, stage, n / sum(n) OVER (PARTITION BY before) AS support FROM moves)
SELECT session_id, signups AS window_id, step_id, concat('skipped_step:', name) AS rule_id FROM cut WHERE ord > coalesce(peak_here, 0) + 1
UNION ALL SELECT session_id, signups, step_id, concat('wrong_order:', name) FROM cut WHERE ord < peak_here
UNION ALL SELECT session_id, signups, step_id, concat('protocol:', before_here, ':', name) FROM cut
WHERE before_here IN (SELECT before FROM shares WHERE support >= 0.25) AND (before_here, name) NOT IN (SELECT (before, stage) FROM shares WHERE support >= 0.25)""")
def c9_debug_windows(spark, sf_dir):
    cut = N.skill_windows(store(S.event_trace(spark, sf_dir)), F.col("name") == "signup")
    spec = settle(P.mine_transitions(cut, 0.25))
    found = C.debug_windows(cut, spec, S.ORDINALS)
    return found.select("session_id", "window_id", "step_id", "rule_id")


@query(f"""WITH {TRACE},
p AS (SELECT session_id, count(*) AS n_rows, string_agg(CASE name WHEN 'signup' THEN 's' WHEN 'view' THEN 'v'
        WHEN 'click' THEN 'c' WHEN 'purchase' THEN 'p' ELSE '?' END, '' ORDER BY step) AS path FROM trace GROUP BY session_id)
SELECT session_id, n_rows, levenshtein(path, 'svcp') AS distance,
       round(1 - levenshtein(path, 'svcp') / greatest(n_rows, 4), 6) AS fitness FROM p""")
def c10_path_distance(spark, sf_dir):
    return D.path_distance(S.event_trace(spark, sf_dir), S.EXPECTED).drop("owner").withColumn("fitness", F.round("fitness", 6))


# Two ways to a purchase, by views or straight by clicks, and a way back from clicks to views.
BRANCHES = W.Workflow({s: s for s in S.EXPECTED}, {"signup": ["view", "click"], "view": ["click"], "click": ["view", "purchase"]}, ["signup"], ["purchase"])


def alignment_sql() -> str:
    """Least weights step by step as a recursive query over one row per run and step, then the way back as another one."""
    names, w = S.EXPECTED, {"i": 1 << 42, "s": (1 << 42) + 1, "r": (1 << 42) + (1 << 21)}
    # Stages skipped between two, 0 being the beginning and 5 the end; what is not listed cannot be.
    way = {(0, 1): [], (0, 2): [1], (0, 3): [1], (0, 4): [1, 3], (0, 5): [1, 3, 4], (1, 2): [], (1, 3): [], (1, 4): [3], (1, 5): [3, 4], (2, 2): [3], (2, 3): [],
           (2, 4): [3], (2, 5): [3, 4], (3, 2): [], (3, 3): [2], (3, 4): [], (3, 5): [4], (4, 5): []}
    taken, origin = {}, {}
    for v in range(1, 5):
        price = f"CASE WHEN t.name = '{names[v - 1]}' THEN 0 ELSE {w['r']} END"
        options = [(u, f"d{u} + {w['s'] * len(way[u, v])}") for u in range(5) if (u, v) in way]
        taken[v] = f"(least({', '.join(o for _, o in options)}) + {price})"
        origin[v] = "CASE " + " ".join(f"WHEN {o} + {price} = {taken[v]} THEN {u}" for u, o in options) + " END"
    step = ", ".join([f"d0 + {w['i']}"] + [f"least({taken[v]}, d{v} + {w['i']})" for v in range(1, 5)])
    came = ", ".join(["-1"] + [f"CASE WHEN {taken[v]} <= d{v} + {w['i']} THEN {origin[v]} ELSE -1 END" for v in range(1, 5)])
    close = [f"d{u} + {w['s'] * len(way[u, 5])}" for u in range(5)]
    end = "CASE " + " ".join(f"WHEN {c} = least({', '.join(close)}) THEN {u}" for u, c in enumerate(close)) + " END"
    gaps = ", ".join(f"({u}, {v}, '{names[k - 1]}')" for (u, v), ks in way.items() for k in ks)
    far = 1 << 61
    return f"""WITH RECURSIVE {TRACE},
ahead AS (
  SELECT session_id, 0::BIGINT AS i, NULL::VARCHAR AS name, 0::BIGINT AS d0, {far} AS d1, {far} AS d2, {far} AS d3, {far} AS d4, [-1, -1, -1, -1, -1] AS came
  FROM trace GROUP BY session_id
  UNION ALL SELECT a.session_id, a.i + 1, t.name, {step}, [{came}]
  FROM ahead a JOIN trace t ON t.session_id = a.session_id AND t.step = a.i + 1),
back AS (
  SELECT session_id, i, {end} AS node, 5 AS later FROM (SELECT * FROM ahead QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY i DESC) = 1)
  UNION ALL SELECT b.session_id, b.i - 1, CASE WHEN came[node + 1] >= 0 THEN came[node + 1] ELSE node END, CASE WHEN came[node + 1] >= 0 THEN node ELSE -1 END
  FROM back b JOIN ahead a ON a.session_id = b.session_id AND a.i = b.i WHERE b.i > 0),
gaps(origin, later, stage) AS (VALUES {gaps})
SELECT b.session_id, b.i + 1 AS at, CASE WHEN later = -1 THEN 'inserted' WHEN a.name = (['signup', 'view', 'click', 'purchase'])[later] THEN 'matched' ELSE 'replaced' END AS move,
       a.name AS stage, CASE WHEN later > 0 THEN (['signup', 'view', 'click', 'purchase'])[later] END AS expected
FROM back b JOIN ahead a ON a.session_id = b.session_id AND a.i = b.i + 1 WHERE later < 5
UNION ALL SELECT b.session_id, b.i + 1, 'skipped', NULL, g.stage FROM back b JOIN gaps g ON g.origin = b.node AND g.later = b.later"""


@query(alignment_sql())
def c10_alignment(spark, sf_dir):
    return W.align_runs(S.event_trace(spark, sf_dir), BRANCHES).select("session_id", "at", "move", "stage", "expected")


@query(f"""WITH {TRACE},
p AS (SELECT session_id, string_agg(CASE name WHEN 'signup' THEN 's' WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' WHEN 'purchase' THEN 'p' ELSE '?' END, '' ORDER BY step) AS path
      FROM trace GROUP BY session_id)
SELECT session_id, levenshtein(path, 'svcp') AS cost FROM p""")
def c10_line_cost(spark, sf_dir):
    """On a straight workflow the cost is the edit distance."""
    return W.run_fit(W.align_runs(S.event_trace(spark, sf_dir), W.line(S.EXPECTED))).select("session_id", "cost")


@query("""WITH b AS (SELECT event_type AS stage, quantile_cont(value, [0.05, 0.95]) AS q FROM events
WHERE strftime(date_trunc('week', ts), '%Y-%m-%d') BETWEEN '2024-01-08' AND '2024-01-22' GROUP BY 1)
SELECT stage, round(q[1], 6) AS lo, round(q[2], 6) AS hi FROM b""")
def p4_ranges_over_versions(spark, sf_dir):
    """Three versions' ranges from sketches kept of every version."""
    rows = S.event_rows(spark, sf_dir)
    kept, span = store(P.range_sketches(rows)), F.col("version").between("2024-01-08", "2024-01-22")
    return P.mine_ranges_over(kept.where(span), rows.where(span), 0.05, 0.95).select("stage", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


SEQUENCES = """
runs AS (SELECT session_id, string_agg(CASE name WHEN 'signup' THEN 's' WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' WHEN 'purchase' THEN 'p' ELSE 'e' END, '' ORDER BY step) AS path
         FROM trace GROUP BY 1),
kinds(k, stage) AS (VALUES ('s', 'signup'), ('v', 'view'), ('c', 'click'), ('p', 'purchase'), ('e', 'error')),
tried AS (
  SELECT k AS q, stage AS said, k AS wanted FROM kinds
  UNION ALL SELECT concat(a.k, b.k), concat_ws('>', a.stage, b.stage), concat(a.k, '.*', b.k) FROM kinds a, kinds b
  UNION ALL SELECT concat(a.k, b.k, c.k), concat_ws('>', a.stage, b.stage, c.stage), concat(a.k, '.*', b.k, '.*', c.k) FROM kinds a, kinds b, kinds c),
held AS (SELECT q, said, wanted, count(*) FILTER (regexp_matches(path, wanted)) / count(*) AS support FROM tried, runs GROUP BY 1, 2, 3 HAVING support >= 0.3),
most AS (SELECT * FROM held a WHERE len(q) > 1 AND NOT EXISTS (
  SELECT 1 FROM held b WHERE len(b.q) > len(a.q) AND regexp_matches(b.q, a.wanted)))"""


@query(f"""WITH {TRACE}, {SEQUENCES}
SELECT concat('sequence:', said, ':') AS rule_id, round(support, 6) AS support FROM (
  SELECT concat(array_to_string(string_split(said, '>')[:-2], '>'), ':', string_split(said, '>')[-1]) AS said, support FROM most)""")
def p1_mine_sequences(spark, sf_dir):
    return P.mine_sequences(S.event_trace(spark, sf_dir), 0.3).select("rule_id", F.round("support", 6).alias("support"))


@query(f"""WITH {TRACE}, {SEQUENCES}
SELECT session_id, concat('sequence:', said) AS rule_id FROM runs, most WHERE NOT regexp_matches(path, wanted)""")
def c9_sequences(spark, sf_dir):
    """Sessions that lack a sequence most others hold, found among all deviations."""
    trace = store(S.event_trace(spark, sf_dir))
    found = C.debug_windows(trace, settle(P.mine_sequences(trace, 0.3)))
    return found.where("rule_kind = 'sequence'").select("session_id", "rule_id")
