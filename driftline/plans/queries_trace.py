"""Registered queries: reading, writing, normalizing, windows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driftline.functions.sizing import shared_dir
from driftline.operators import checks as C
from driftline.operators import normalize as N
from driftline.operators import release as E
from driftline.operators import scoring as G
from driftline.operators import spec as P
from driftline.plans.registry import DRIFT, TRACE, query
from driftline.sources import bindings as S
from driftline.sources import tables as IO
from driftline.sources import schemas


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def conform(df, ddl: str):
    """Exactly the columns of a canonical table."""
    from pyspark.sql.types import StructType
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])


@query(f"""WITH {TRACE}
SELECT session_id, name, layer, count(*) AS n, CAST(sum(step) AS BIGINT) AS steps, round(sum(value), 4) AS total
FROM trace GROUP BY session_id, name, layer""")
def io1_read_trace(spark, sf_dir):
    path = scratch(spark, "trace")
    conform(S.event_trace(spark, sf_dir), schemas.TRACE).write.parquet(path)
    return IO.read_trace(spark, path).groupBy("session_id", "name", "layer").agg(
        F.count("*").alias("n"), F.sum("step").alias("steps"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH {TRACE},
p AS (SELECT *, CASE WHEN ord IS NULL THEN 0 WHEN ord > coalesce(peak, 0) THEN 1 WHEN ord < peak THEN -1 ELSE 0 END AS move FROM trace)
SELECT session_id, sum(move)::BIGINT AS progress, count(*) AS n_rows FROM p GROUP BY session_id""")
def io1_stored_trace(spark, sf_dir):
    """Progress of sessions read from a bucketed store."""
    path = scratch(spark, "stored-trace")
    IO.store_trace(conform(S.event_trace(spark, sf_dir), schemas.TRACE), path, buckets=8)
    return G.progress_scores(IO.open_trace(spark, path), S.ORDINALS).select("session_id", "progress", "n_rows")


@query("""WITH b AS (SELECT event_type AS stage, quantile_cont(value, [0.05, 0.95]) AS q FROM events GROUP BY 1)
SELECT stage, concat('range::', stage, ':') AS rule_id, round(q[1], 6) AS lo, round(q[2], 6) AS hi FROM b""")
def io2_read_spec(spark, sf_dir):
    path = scratch(spark, "spec")
    P.mine_ranges(S.event_rows(spark, sf_dir), 0.05, 0.95, skill="signup").write.parquet(path)
    return IO.read_spec(spark, path).select(
        "stage", "rule_id", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(f"""WITH {DRIFT} SELECT session_id, 'unsupported claim' AS problem FROM outcome WHERE NOT good""")
def io3_read_feedback(spark, sf_dir):
    path = scratch(spark, "feedback")
    bad = S.event_outcome(S.event_trace(spark, sf_dir)).where("not good")
    conform(bad.withColumn("problem", F.lit("unsupported claim")), schemas.FEEDBACK).write.json(path)
    return IO.read_feedback(spark, path, "json").select("session_id", "problem")


@query("""SELECT CAST(doc_id AS VARCHAR) AS finding_id, 'first' AS reviewer,
       CASE WHEN quality = 0 THEN 'correct' ELSE 'confirm' END AS verdict FROM labels
UNION ALL
SELECT CAST(doc_id AS VARCHAR), 'second', CASE WHEN quality = 0 THEN 'correct' ELSE 'insufficient' END
FROM labels WHERE toxic = 1""")
def io4_read_verdicts(spark, sf_dir):
    path = scratch(spark, "verdicts")
    conform(S.document_verdicts(spark, sf_dir), schemas.VERDICTS).write.parquet(path)
    return IO.read_verdicts(spark, path).select("finding_id", "reviewer", "verdict")


@query(f"""WITH {DRIFT} SELECT 'signup' AS skill, session_id, step_id, rule_id, severity FROM drift""")
def io5_write_findings(spark, sf_dir):
    path = scratch(spark, "findings")
    trace = S.event_trace(spark, sf_dir)
    IO.write_findings(conform(drift_findings(trace), schemas.FINDINGS), path)
    return spark.read.schema(schemas.FINDINGS).parquet(path).select(
        "skill", "session_id", "step_id", "rule_id", "severity")


@query("""SELECT CAST(d.doc_id AS VARCHAR) AS case_id,
       CASE WHEN l.quality = 0 THEN 'hard' ELSE 'golden' END AS set_name,
       CASE WHEN d.doc_id % 100 < 20 THEN 'test' ELSE 'train' END AS split
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def io7_write_evalset(spark, sf_dir):
    path = scratch(spark, "evalset")
    cases = S.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("case_id"))
    hard = S.document_verdicts(spark, sf_dir).where("verdict = 'correct'").select(F.col("finding_id").alias("case_id"))
    sets = E.assign_sets(cases, hard, number=F.col("case_id").cast("bigint"))
    IO.write_evalset(conform(sets, schemas.EVALSET), path)
    return spark.read.schema(schemas.EVALSET).parquet(path).select("case_id", "set_name", "split")


def drift_findings(trace):
    """Skipped and misordered steps of the event trace."""
    return C.place_violations(trace, S.ORDINALS)


@query("""SELECT 'event' AS feed, CAST(user_id AS VARCHAR) AS owner, event_id AS step_id, event_type AS stage,
       CASE WHEN event_type IN ('view', 'error') THEN 'event' ELSE 'action' END AS kind,
       json_extract_string(props, '$.k') AS artifact_id, value FROM events
UNION ALL
SELECT 'conversation', CAST(conv_id AS VARCHAR), turn, role, 'event', NULL, CAST(length(text) AS DOUBLE)
FROM conversations""")
def n1_normalize(spark, sf_dir):
    events = N.normalize(S.table(spark, sf_dir, "events"), {**S.EVENT_MAPPING, "ts": "cast(ts as timestamp)"})
    talks = N.normalize(S.table(spark, sf_dir, "conversations"), S.CONVERSATION_MAPPING)
    both = events.withColumn("feed", F.lit("event")).unionByName(
        talks.withColumn("feed", F.lit("conversation")), allowMissingColumns=True)
    return both.select("feed", "owner", "step_id", "stage", "kind", "artifact_id", "value")


@query("""SELECT event_id AS step_id, json_extract_string(props, '$.k') AS artifact_id,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events""")
def n1_normalize_json(spark, sf_dir):
    raw = S.table(spark, sf_dir, "events").select(
        F.concat(F.lit('{"id":'), "event_id", F.lit(',"p":'), "props", F.lit("}")).alias("payload"))
    return N.normalize_json(raw, "payload", {
        "step_id": ("$.id", "bigint"), "artifact_id": ("$.p.k", "string"), "value": ("$.p.k", "double"),
    }).select("step_id", "artifact_id", "value")


@query(f"""WITH {TRACE} SELECT step_id, name, layer FROM trace""")
def n2_tag_layer(spark, sf_dir):
    return N.tag_layer(S.event_rows(spark, sf_dir), S.LAYERS).select("step_id", "name", "layer")


@query(f"""WITH {TRACE},
c AS (SELECT *, CASE WHEN before IS NULL OR before <> name THEN 1 ELSE 0 END AS changed FROM trace)
SELECT session_id, step_id, concat(session_id, '/', signups) AS task_id, name AS stage, step,
       CAST(sum(changed) OVER (PARTITION BY session_id ORDER BY ts, step_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stage_no
FROM c""")
def n3_assign_levels(spark, sf_dir):
    return S.event_trace(spark, sf_dir).select(
        "session_id", "step_id", "task_id", "stage", F.col("step").cast("bigint").alias("step"), "stage_no")


@query(f"""WITH {TRACE} SELECT step_id, session_id FROM trace""")
def n4_sessionize(spark, sf_dir):
    return N.sessionize(S.event_rows(spark, sf_dir), "owner", "24 hours").select("step_id", "session_id")


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey,
       strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""")
def n5_dedup_events(spark, sf_dir):
    rows = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    first = N.dedup_events(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return first.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
                        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), "l_extendedprice")


@query("""WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS session_id, count(*) AS n_rows, max(turn) - min(turn) + 1 AS span,
                arg_max(role, turn) AS last_name FROM conversations GROUP BY conv_id)
SELECT session_id, n_rows, last_name, span - n_rows AS missing_steps, round(n_rows / span, 6) AS present,
       last_name = 'assistant' AS ended FROM c""")
def n6_completeness(spark, sf_dir):
    talks = N.normalize(S.table(spark, sf_dir, "conversations"), S.CONVERSATION_MAPPING)
    return N.completeness(talks, ["assistant"], ["session_id"]).withColumn("present", F.round("present", 6))


@query("""SELECT event_id AS step_id, event_type AS stage, 'k' AS field, json_extract_string(props, '$.k') AS value FROM events""")
def n7_explode_state(spark, sf_dir):
    return N.explode_state(S.event_rows(spark, sf_dir)).select("step_id", "stage", "field", "value")


@query(f"""WITH {TRACE} SELECT session_id, signups AS window_id, step_id, step FROM trace WHERE signups > 0""")
def w1_skill_windows(spark, sf_dir):
    cut = N.skill_windows(S.event_trace(spark, sf_dir), F.col("name") == "signup")
    return cut.select("session_id", "window_id", "step_id", F.col("step").cast("bigint").alias("step"))


@query(f"""WITH {TRACE},
p AS (SELECT *, sum(CASE WHEN name = 'purchase' THEN 1 ELSE 0 END) OVER (
        PARTITION BY session_id, signups ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM trace)
SELECT session_id, signups AS window_id, step_id, step FROM p WHERE signups > 0 AND coalesce(ended, 0) = 0""")
def w1_skill_windows_until(spark, sf_dir):
    cut = N.skill_windows(S.event_trace(spark, sf_dir), F.col("name") == "signup", F.col("name") == "purchase")
    return cut.select("session_id", "window_id", "step_id", F.col("step").cast("bigint").alias("step"))


@query(f"""WITH {TRACE}
SELECT session_id, signups AS window_id, min(step) AS first_step, max(step) AS last_step, count(*) AS n_rows,
       round(date_diff('microsecond', min(ts), max(ts)) / 1e6, 6) AS seconds
FROM trace WHERE signups > 0 GROUP BY session_id, signups""")
def w2_window_summary(spark, sf_dir):
    cut = N.skill_windows(S.event_trace(spark, sf_dir), F.col("name") == "signup")
    out = N.window_summary(cut).select("session_id", "window_id", "first_step", "last_step", "n_rows", "seconds")
    return out.withColumns({"first_step": F.col("first_step").cast("bigint"), "last_step": F.col("last_step").cast("bigint"),
                            "seconds": F.round("seconds", 6)})


@query(f"""WITH {TRACE}
SELECT session_id, signups AS window_id, row_number() OVER (PARTITION BY session_id, signups ORDER BY step) AS place, name
FROM trace WHERE signups > 0""")
def w2_window_names(spark, sf_dir):
    cut = N.skill_windows(S.event_trace(spark, sf_dir), F.col("name") == "signup")
    return N.window_names(cut).select("session_id", "window_id", "place", "name")
