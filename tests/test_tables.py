"""Reading, writing, shared storage, the entry points, and known counts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from driftline.functions import sizing
from driftline.operators import attribution as A
from driftline.operators import checks as C
from driftline.operators import graph as B
from driftline.operators import release as E
from driftline.operators import scoring as G
from driftline.plans import catalog, flows
from driftline.plans.queries_trace import conform, scratch
from driftline.sources import bindings as S
from driftline.sources import schemas
from driftline.sources import tables as IO
from pyspark.sql import functions as F
from traces import trace

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("form", ["parquet", "json", "orc"])
def test_trace_round_trip(spark, form):
    df = conform(trace(spark, {"a": ["signup", {"stage": "view", "state": {"k": None}}]}), schemas.TRACE)
    path = scratch(spark, "round")
    df.write.format(form).save(path)
    back = IO.read_trace(spark, path, form).orderBy("step").collect()
    assert [r["stage"] for r in back] == ["signup", "view"] and back[1]["state"] in ({"k": None}, {})
    assert back[0]["ts"] == df.orderBy("step").first()["ts"]


def test_unknown_form(spark):
    with pytest.raises(ValueError):
        IO.read_trace(spark, "/nowhere", "xml")


@pytest.mark.parametrize("kind", ["gates", "evidence", "results", "ledger", "routing", "advice", "votes"])
def test_flow_tables_round_trip(spark, kind):
    ddl = getattr(schemas, {"evidence": "PROOFS"}.get(kind, kind.upper()))
    values = {"string": "'x'", "bigint": "7L", "int": "7", "boolean": "true", "double": "0.5D", "timestamp": "timestamp'2024-01-01 00:00:00'"}
    fields = [f.split() for f in ddl.split(", ")]
    row = spark.sql("SELECT " + ", ".join(f"{values[t]} AS {n}" for n, t in fields))
    path = scratch(spark, kind)
    row.union(row.select(*[F.lit(None).cast(t).alias(n) for n, t in fields])).write.parquet(path)
    back = getattr(IO, f"read_{kind}")(spark, path)
    assert back.schema.simpleString() == row.schema.simpleString() and set(map(tuple, back.collect())) == {tuple(row.first()), (None,) * len(fields)}


def test_written_values_lie_in_few_files(spark):
    cases = spark.range(2000).selectExpr("cast(id AS string) case_id", "if(id % 3 = 0, 'hard', 'golden') set_name", "'test' split", "cast(null AS string) expected")
    path = scratch(spark, "few")
    IO.write_evalset(cases.repartition(40), path)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() <= 4


def test_a_round_from_stored_tables(spark):
    folder = {}
    for name, rows in {"results": [("1", "a", True, 1.0), ("2", "a", True, 1.0), ("2", "b", True, 1.0)], "ledger": [("b", "accept", "me", None)],
                       "routing": [("slow", "model")], "votes": [("1", "x", "confirm"), ("1", "y", "confirm"), ("2", "x", "correct")]}.items():
        folder[name] = scratch(spark, name)
        spark.createDataFrame(rows, getattr(schemas, name.upper())).write.parquet(folder[name])
    results = IO.read_results(spark, folder["results"])
    base, cand = (results.where(F.col("version") == v).drop("version") for v in "ab")
    auto = spark.createDataFrame([("1", "slow"), ("2", "slow")], "finding_id string, auto_cause string")
    verdicts = spark.createDataFrame([("1", "x", "confirm", None, 1), ("2", "x", "correct", "late", 1)], "finding_id string, reviewer string, verdict string, cause string, round int")
    done = flows.close_loop(auto, verdicts, IO.read_votes(spark, folder["votes"]), IO.read_routing(spark, folder["routing"]), base, cand, {"pass_rate": 0.5}, 2, ["round"])
    gate = done.gate.first()
    assert (gate["regressions"], gate["not_run"], gate["accepted"]) == (1, 1, False)
    assert {(r["target"], r["n"]) for r in done.routes.collect()} == {("model", 1), ("unrouted", 1)}
    assert E.accepted(spark.createDataFrame([("b", False)], "version string, accepted boolean"), IO.read_ledger(spark, folder["ledger"])).count() == 0


def test_findings_are_laid_out_by_skill(spark):
    df = trace(spark, {"a": ["signup", {"stage": "purchase", "skill": "pay"}]})
    found = conform(C.skipped_steps(df, S.ORDINALS), schemas.FINDINGS)
    path = scratch(spark, "findings")
    IO.write_findings(found, path)
    one = spark.read.schema(schemas.FINDINGS).parquet(path).where("skill = 'pay'")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(skill" in one._jdf.queryExecution().executedPlan().toString()


def test_evalset_round_trip(spark):
    cases = spark.range(40).select(F.col("id").cast("string").alias("case_id"))
    sets = E.assign_sets(cases, cases.where("case_id = '7'"))
    path = scratch(spark, "evalset")
    IO.write_evalset(conform(sets, schemas.EVALSET), path)
    assert spark.read.schema(schemas.EVALSET).parquet(path).where("set_name = 'hard'").count() == 1


def test_store_keeps_rows_and_schema(spark):
    df = trace(spark, {"a": ["signup", "view"]})
    kept = sizing.store(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == 2


class Cluster:
    """Stands for a session on a cluster."""

    def __init__(self, named, master="spark://host:7077"):
        self.conf = {} if named is None else {"spark.checkpoint.dir": named}
        self.sparkContext = self
        self.master, self.used = master, None

    def getCheckpointDir(self):
        return self.used

    def setCheckpointDir(self, folder):
        self.used = folder


def test_shared_dir_is_the_named_one():
    cluster = Cluster("hdfs://shared/spark")
    assert sizing.shared_dir(cluster) == cluster.used == "hdfs://shared/spark"
    with pytest.raises(RuntimeError):
        sizing.shared_dir(Cluster(None))


@pytest.mark.parametrize("name, condition, n", [
    ("n4_sessionize", None, 10_000),
    ("v3_claim_support", "status = 'unsupported'", 818),
    ("c4_skipped_steps", None, 1_190),
    ("c5_order_violations", None, 4_360),
    ("c2_bad_updates", None, 4_353),
    ("w1_skill_windows", None, 6_721),
    ("v4_false_success", "status = 'contradicted'", 4_313),
    ("v5_silent_failures", None, 176),
    ("a1_build_graph", "edge_kind = 'artifact'", 648),
    ("n6_completeness", "ended", 54),
    ("v7_cites", None, 26),
    ("g4_trajectory_anomaly", None, 1_055),
])
def test_known_counts(spark, name, condition, n):
    out = catalog.QUERIES[name](spark, SF)
    assert (out.where(condition) if condition else out).count() == n


def test_walk_depths(spark):
    depths = catalog.QUERIES["a4_trace_back"](spark, SF).groupBy("depth").count().orderBy("depth").collect()
    assert [r["count"] for r in depths] == [2014, 1873, 1768, 1602, 1460, 1315]


def test_entry_points(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() == 202
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [["driftline/llm", "tests/llm"], ["driftline/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_optional_parts(tmp_path, gone):
    root = Path(__file__).resolve().parent.parent
    skip = {str(root / g) for g in gone}
    shutil.copytree(root, tmp_path / "copy", ignore=lambda folder, names: {n for n in names if f"{folder}/{n}" in skip or n in (".git", "__pycache__", ".pytest_cache")})
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith(('op1', 'pipeline')) for q in e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.ORACLES)), "False"], done.stderr[-2000:]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["v3_claim_support", "c4_skipped_steps", "n3_assign_levels", "w1_skill_windows", "a11_error_lookback"])
def test_one_shuffle_from_raw_rows(spark, name):
    assert exchanges(catalog.QUERIES[name](spark, SF)) == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "trace")
    IO.store_trace(conform(S.event_trace(spark, SF), schemas.TRACE), path, buckets=6)
    return IO.open_trace(spark, path)


@pytest.mark.parametrize("build", [
    lambda t: C.skipped_steps(t, S.ORDINALS), lambda t: G.progress_scores(t, S.ORDINALS), lambda t: B.build_graph(t)[1], lambda t: A.error_lookback(t, 3)])
def test_a_stored_trace_is_not_shuffled(spark, stored, build):
    plan = build(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_a_long_stored_session_is_several_tasks(spark, tmp_path, cut_groups):
    cut_groups(10)
    df = conform(trace(spark, {"long": ["signup", "view", "click", "view"] * 20, "short": ["signup", "click"]}), schemas.TRACE)
    IO.store_trace(df, str(tmp_path / "t"), buckets=8)
    held = IO.open_trace(spark, str(tmp_path / "t"))
    pieces = held.where("session_id = 'long'").groupBy("seg").count().collect()
    assert len(pieces) >= 4 and sum(p["count"] for p in pieces) == 80
    files = held.where("session_id = 'long'").select(F.input_file_name()).distinct().count()
    assert files >= 3
    plain = lambda rows: sorted((r["session_id"], r["step_id"], r["rule_id"]) for r in rows.collect())
    assert plain(C.skipped_steps(held, S.ORDINALS)) == plain(C.skipped_steps(df, S.ORDINALS))
    assert sorted(tuple(r) for r in G.progress_scores(held, S.ORDINALS).select("session_id", "progress", "n_rows").collect()) == sorted(
        tuple(r) for r in G.progress_scores(df, S.ORDINALS).select("session_id", "progress", "n_rows").collect())


def test_only_needed_columns_are_scanned(spark):
    plan = catalog.QUERIES["v3_claim_support"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_ranks_are_cut_before_the_shuffle(spark):
    plan = catalog.QUERIES["h3_review_queue"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange"):]


def test_small_rules_are_broadcast(spark):
    plan = catalog.QUERIES["c6_state_violations"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
