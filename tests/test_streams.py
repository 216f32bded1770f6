"""Streams give what the batch operators give for the rows that are settled."""

import os
import random
import shutil
import subprocess
import sys
import uuid
from datetime import timedelta
from pathlib import Path

import pytest
from driftline.functions.sizing import shared_dir
from driftline.operators import normalize as N
from driftline.plans import queries_streams as Q
from driftline.sources import bindings as S
from driftline.streaming import feeds as T
from pyspark.sql import functions as F
from traces import ORDINALS, START, got

SF = "/root/testdata/sf0.001"
SCHEMA = "session_id string, step_id bigint, ts timestamp, stage string, owner string"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_claims_against_brute_force(spark):
    rows = [(r["user_id"], r["ts"], r["event_type"], r["event_id"]) for r in S.table(spark, SF, "events").collect()]
    clicks = [(u, t) for u, t, e, _ in rows if e == "click"]
    bare = {i: t for u, t, e, i in rows if e == "purchase" and not any(
        v == u and t - timedelta(hours=12) <= s < t for v, s in clicks)}
    found = {r["step_id"] for r in Q.t5_stream_claims(spark, SF).collect()}
    end = max(t for _, t, _, _ in rows)
    assert found <= set(bare)
    assert {i for i, t in bare.items() if t < end - timedelta(hours=17)} <= found


@pytest.mark.parametrize("batches", [1, 3, 50])
def test_skips_do_not_depend_on_batches(spark, batches):
    """Rows come up to half an hour late; which batch brings them makes no difference."""
    rnd = random.Random(3)
    rows = [(s, i * 4 + k, START + timedelta(minutes=5 * i + k), rnd.choice(list(ORDINALS) + ["error"]), s) for i in range(60) for k, s in enumerate("abcd")]
    end = rows[-1][2]
    rows.append(("z", 999, end + timedelta(hours=3), "signup", "z"))
    order = sorted(rows[:-1], key=lambda r: r[2] + timedelta(minutes=rnd.randrange(30))) + rows[-1:]
    folder, base = f"{shared_dir(spark)}/skips-{uuid.uuid4().hex}", None
    size = -(-len(order) // batches)
    for k in range(0, len(order), size):
        spark.createDataFrame(order[k:k + size], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = T.stream_trace(spark, folder, SCHEMA, max_files=1)
    base, seen = T.run_available(T.stream_skips(stream, ORDINALS, "1 hour"), "skips-test", base)
    assert len([b for b in seen if b[1]]) == -(-len(order) // size)
    found = [tuple(r) for r in spark.read.parquet(f"{base}/rows").select("session_id", "step_id", "reached").collect()]
    peak, want = dict.fromkeys("abcdz", 0), []
    for s, i, t, stage, _ in rows[:-1]:
        place = ORDINALS.get(stage)
        if place:
            if place > peak[s] + 1:
                want.append((s, i, peak[s]))
            peak[s] = max(peak[s], place)
    assert sorted(found) == sorted(want)


def test_a_forgotten_session_starts_anew(spark):
    folder = f"{shared_dir(spark)}/skips-{uuid.uuid4().hex}"
    day = timedelta(days=1)
    for k, row in enumerate([("a", 1, START, "signup", "a"), ("b", 2, START + 5 * day, "signup", "b"), ("b", 3, START + 6 * day, "view", "b"), ("a", 4, START + 7 * day, "view", "a"),
                             ("b", 5, START + 9 * day, "view", "b")]):
        arrive(spark, folder, [row])
    stream = T.stream_trace(spark, folder, SCHEMA, max_files=1)
    base, _ = T.run_available(T.stream_skips(stream, ORDINALS, "1 hour", "2 days"), "forget-test")
    assert got(spark.read.parquet(f"{base}/rows"), "session_id", "step_id", "reached") == [("a", 4, 0)]


def test_late_rows_of_many_batches(spark):
    """Over a hundred batches, more than a query's own list of recent reports holds."""
    folder = f"{shared_dir(spark)}/many-{uuid.uuid4().hex}"
    rows = [("s", i, START + timedelta(hours=5 if i == 0 else 0, seconds=i), "view", "s") for i in range(104)]
    spark.createDataFrame(rows, SCHEMA).repartitionByRange(104, "step_id").write.parquet(folder)
    stream = T.stream_trace(spark, folder, SCHEMA, max_files=1).select("step_id", "ts")
    base, batches = T.run_available(T.stream_dedup(stream, ["step_id"], "1 hour"), "many-test")
    told = T.stream_late(spark, batches).agg(F.sum("n_rows"), F.sum("late"), F.count_if(F.col("n_rows") > 0)).first()
    assert told[0] == 104 and told[2] > 100 and spark.read.parquet(f"{base}/rows").count() + told[1] == 104


def test_sessions_equal_batch_once_closed(spark):
    rows = [("u", i, START + timedelta(hours=h), "view", "u") for i, h in enumerate((0, 1, 2, 9, 10, 40))]
    folder = f"{shared_dir(spark)}/sessions-{uuid.uuid4().hex}"
    arrive(spark, folder, rows)
    stream = T.stream_trace(spark, folder, SCHEMA)
    found = T.result_of(T.stream_sessions(stream, "owner", "6 hours", "1 hour"), "sessions-test")
    batch = N.sessionize(spark.createDataFrame(rows, SCHEMA).drop("session_id"), "owner", "6 hours")
    sizes = batch.groupBy("session_id").agg(F.count("*").alias("n")).where("session_id <> 'u-3'")
    assert got(found, "n_rows") == got(sizes, "n") == [(2,), (3,)]


def test_late_rows_are_dropped_and_counted(spark):
    out = Q.t7_stream_late(spark, SF).first()
    assert out["late"] > 0 and out["kept"] + out["late"] == out["n_rows"] == 1000


SKIPS_ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from driftline.session import local_session
from driftline.streaming import feeds
spark = local_session(2, shuffle_partitions=2)
rows = "ts timestamp, session_id string, step_id bigint, stage string"
at = lambda m: f"2024-01-01 10:{{m:02d}}:00"
given = [(at(0), "a", 1, "signup"), (at(1), "a", None, "click"), (None, "a", 7, "purchase"), (at(2), None, 8, "purchase"), (at(3), "a", 9, "click"), ("2024-03-01 00:00:00", "z", 10, "signup")]
spark.createDataFrame(given, "ts string, session_id string, step_id bigint, stage string").selectExpr("cast(ts as timestamp) ts", "session_id", "step_id", "stage").coalesce(1).write.parquet({folder!r})
got = feeds.result_of(feeds.stream_skips(feeds.stream_trace(spark, {folder!r}, rows), {{"signup": 1, "view": 2, "click": 3, "purchase": 4}}, "1 hour"), "skips")
print("GOT", sorted(map(tuple, got.collect()), key=str))
"""


def test_skips_from_another_folder_and_with_nulls(tmp_path):
    """The package lies on the driver's path only; the runner of the state starts elsewhere."""
    script = SKIPS_ELSEWHERE.format(root=str(Path(__file__).resolve().parent.parent), folder=str(tmp_path / "rows"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "GOT [('a', None, 'click', 1)]" in done.stdout, done.stderr[-3000:]


def test_reports_sent_again_replace(spark, tmp_path):
    """Grown, repeated and late partial reports of sessions, one of them without an id; a batch that is run again; forgetting."""
    day = "2024-01-{:02d} 10:00:00"
    full = {"a": ["x", "bad", "bad"], "b": ["bad"], None: ["bad", "x"], "c": ["x", "x"]}

    def report(session, steps, version, d=1):
        return [(session, k, full[session][k], version, day.format(d)) for k in range(steps)]

    batches = [report("a", 2, 1) + report("b", 1, 5) + report(None, 2, 1), report("a", 3, 2) + report("b", 1, 5) + report("b", 1, 4),
               report("a", 2, 1) + report("c", 2, 1, 20) + report("c", 2, 1, 20)]
    schema = "session_id string, step_id int, name string, report int, at string"
    for rows in batches:
        spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    arriving = lambda: spark.readStream.schema(schema + ", ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    asked = []

    def judge(rows):
        asked.append(sorted({str(r[0]) for r in rows.select("session_id").collect()}))
        return rows.where("name = 'bad'").select("session_id", "step_id")

    told = lambda base: sorted(map(str, map(tuple, T.current(spark, base).collect())))
    want = sorted(map(str, [("a", 1, 2), ("a", 2, 2), ("b", 0, 5), (None, 0, 1)]))
    base = T.upsert_reports(arriving(), judge, "t", buckets=3, base=str(tmp_path / "out"))
    assert told(base) == want and asked == [["None", "a", "b"], ["a"], ["c"]]
    shutil.rmtree(tmp_path / "out/state")           # the stream forgets its batches and runs all of them again
    T.upsert_reports(arriving(), judge, "t", buckets=3, base=base)
    assert told(base) == want and asked[3:] == [[], [], []]
    short = T.upsert_reports(arriving(), judge, "t", buckets=1, base=str(tmp_path / "short"), forget="5 days")
    assert told(short) == [] and spark.read.parquet(f"{short}/sessions").select("session_id").collect()[0][0] == "c"
