"""Registered queries: streams run over what has arrived."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driftline.functions.sizing import settle, shared_dir, store
from driftline.operators import checks as C
from driftline.operators import normalize as N
from driftline.operators import spec as P
from driftline.plans.registry import DRIFT, query
from driftline.sources import bindings as S
from driftline.streaming import feeds as T

RAW = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DELAY = "1 hour"


def arriving(spark, sf_dir):
    """The event file as a stream of trace rows with event time."""
    raw = T.stream_trace(spark, sf_dir, RAW, files="events.parquet")
    return N.normalize(raw, {**S.EVENT_MAPPING, "ts": "cast(ts as timestamp)"})


@query("SELECT event_id AS step_id, event_type AS name, CAST(user_id AS VARCHAR) AS owner FROM events")
def t1_stream_trace(spark, sf_dir):
    return T.result_of(arriving(spark, sf_dir).select("step_id", "name", "owner"), "trace")


@query("SELECT event_id AS step_id, event_type AS name FROM events")
def t2_stream_dedup(spark, sf_dir):
    rows = arriving(spark, sf_dir).select("step_id", "name", "ts")
    again = arriving(spark, sf_dir).select("step_id", "name", (F.col("ts") + F.expr("interval 10 minutes")).alias("ts"))
    return T.result_of(T.stream_dedup(rows.union(again), ["step_id"], DELAY).select("step_id", "name"), "dedup")


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR
              THEN 0 ELSE 1 END AS opens FROM events),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM o),
r AS (SELECT user_id, n, count(*) AS n_rows, min(ts) AS a, max(ts) AS b FROM s GROUP BY 1, 2)
SELECT CAST(user_id AS VARCHAR) AS owner, n_rows, strftime(a, '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(b, '%Y-%m-%d %H:%M:%S') AS last_ts
FROM r WHERE b + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def t3_stream_sessions(spark, sf_dir):
    out = T.stream_sessions(arriving(spark, sf_dir), "owner", "6 hours", DELAY)
    return T.result_of(out, "sessions").select(
        "owner", "n_rows", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_ts", "last_ts")])


RATES = """
SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, name, count(*) AS n_rows, count(*) FILTER (bad) AS n_bad,
       round(count(*) FILTER (bad) / count(*), 6) AS rate
FROM spans WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2"""


@query(f"""WITH spans AS (SELECT date_trunc('day', ts) AS w, 'all' AS name, event_type = 'error' AS bad FROM events) {RATES}""")
def t4_stream_rates(spark, sf_dir):
    return rates(spark, sf_dir, None)


@query(f"""WITH spans AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') - to_hours(6 * o) AS w, 'all' AS name,
                event_type = 'error' AS bad FROM events, (SELECT unnest([0, 1, 2, 3]) AS o)) {RATES}""")
def t4_stream_rates_sliding(spark, sf_dir):
    return rates(spark, sf_dir, "6 hours")


def rates(spark, sf_dir, slide):
    out = T.result_of(T.stream_rates(arriving(spark, sf_dir), ~F.col("ok"), "1 day", slide, DELAY), "rates")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), F.lit("all").alias("name"),
                      "n_rows", "n_bad", F.round("rate", 6).alias("rate"))


@query("""SELECT CAST(p.user_id AS VARCHAR) AS owner, p.event_id AS step_id, strftime(p.ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events p
WHERE p.event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'click' AND e.user_id = p.user_id
    AND e.ts < p.ts AND e.ts >= p.ts - INTERVAL 12 HOUR)
  AND p.ts < (SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase')) FROM events) - INTERVAL 4 HOUR""")
def t5_stream_claims(spark, sf_dir):
    """Purchases without a click of the same user in the 12 hours before, but for those within the delay and one bucket of where the slower of both feeds ends."""
    claims = arriving(spark, sf_dir).where("name = 'purchase'").select("owner", "step_id", "ts")
    proofs = arriving(spark, sf_dir).where("name = 'click'").select("owner", "ts")
    out = T.result_of(T.stream_claims(claims, proofs, "owner", "12 hours", DELAY), "claims")
    return out.select("owner", "step_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("""WITH o AS (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END AS ord FROM events),
p AS (SELECT *, coalesce(max(ord) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM o)
SELECT CAST(user_id AS VARCHAR) AS session_id, event_id AS step_id, event_type AS stage, reached FROM p
WHERE ord > reached + 1 AND ts <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def t6_stream_skips(spark, sf_dir):
    rows = arriving(spark, sf_dir).withColumn("session_id", F.col("owner"))
    return T.result_of(T.stream_skips(rows, S.ORDINALS, DELAY, "90 days"), "skips")


@query("""WITH late AS (SELECT count(*) AS n FROM events WHERE value > 100
  AND ts <= (SELECT max(ts) FROM events WHERE value <= 100) - INTERVAL 1 HOUR)
SELECT (SELECT count(*) FROM events) AS n_rows, (SELECT n FROM late) AS late,
       (SELECT count(*) FROM events) - (SELECT n FROM late) AS kept""")
def t7_stream_late(spark, sf_dir):
    """Rows of high value arrive after all others, most of them too late."""
    folder = f"{shared_dir(spark)}/arrivals-{uuid.uuid4().hex}"
    events = S.table(spark, sf_dir, "events")

    def seen():
        raw = T.stream_trace(spark, folder, RAW)
        return T.stream_dedup(N.normalize(raw, {**S.EVENT_MAPPING, "ts": "cast(ts as timestamp)"}).select("step_id", "ts"), ["step_id"], DELAY)

    events.where("value <= 100").write.parquet(folder)
    base, first = T.run_available(seen(), "late")
    events.where("not (value <= 100)").write.mode("append").parquet(folder)
    _, second = T.run_available(seen(), "late", base)
    told = T.stream_late(spark, first + second)
    kept = spark.read.parquet(f"{base}/rows").count()
    return told.agg(F.sum("n_rows").alias("n_rows"), F.sum("late").alias("late"), F.lit(kept).cast("bigint").alias("kept"))


JUDGED = f"""WITH {DRIFT},
moves AS (SELECT before, name AS stage, count(*) AS n FROM trace WHERE before IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT before, stage, n / sum(n) OVER (PARTITION BY before) AS support FROM moves)
SELECT session_id, step_id, rule_id FROM drift
UNION ALL SELECT session_id, step_id, concat('protocol:', before, ':', name) FROM trace
WHERE before IN (SELECT before FROM shares WHERE support >= 0.2) AND (before, name) NOT IN (SELECT (before, stage) FROM shares WHERE support >= 0.2)"""


@query(JUDGED)
def t8_stream_judge(spark, sf_dir):
    """Reports of complete sessions, a third of the files a batch, judged by given rules as they arrive."""
    trace = store(S.event_trace(spark, sf_dir))
    spec = settle(P.mine_transitions(trace, 0.2))
    folder = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    tasks = spark.sparkContext.defaultParallelism
    trace.repartition(3 * tasks, "session_id").write.parquet(folder)
    arrivals = spark.readStream.schema(trace.schema).option("maxFilesPerTrigger", tasks).parquet(folder)
    base = T.judge_arrivals(arrivals, lambda rows: C.debug_windows(rows, spec, S.ORDINALS), "judge")
    return T.judged(spark, base).select("session_id", "step_id", "rule_id")


@query(JUDGED)
def t1_resent_reports(spark, sf_dir):
    """Half of the sessions are first reported in part; whole reports follow, some twice, and then the partial ones come again."""
    trace = store(S.event_trace(spark, sf_dir))
    spec = settle(P.mine_transitions(trace, 0.2))
    grown = F.pmod(F.crc32("session_id"), F.lit(2)) == 0
    part = trace.where(grown & (F.col("step") <= 3)).withColumn("report", F.lit(1))
    whole = trace.withColumn("report", F.lit(2))
    folder = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    tasks = spark.sparkContext.defaultParallelism       # files of a sending; a report lies in one of them whole
    for sent in (part.unionByName(whole.where(~grown)), whole.where(grown), whole.where(F.pmod(F.crc32("session_id"), F.lit(3)) == 0), part):
        sent.repartition(tasks, "session_id").write.mode("append").parquet(folder)
    arrivals = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", tasks).parquet(folder)
    base = T.upsert_reports(arrivals, lambda rows: C.debug_windows(rows, spec, S.ORDINALS), "upsert", buckets=8)
    return T.current(spark, base).select("session_id", "step_id", "rule_id")
