"""The session graph and the way back from symptoms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.ordered import last_known, previous, running, session_key
from driftline.functions.sizing import settle, small_side, store
from driftline.operators.walks import walk_sessions


def build_graph(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (steps) and edges: each step to the next, each artifact's last writer to its reader."""
    nodes = df.select("session_id", "step_id", "step", "kind", "stage", "name", "artifact_id", "ok")
    chain = running(df, {"src": previous("step_id")}).where("src is not null")
    writes = F.when(F.contains("rw", F.lit("w")), F.col("step_id"))
    reads = running(df.where("artifact_id is not null"), {"src": last_known(writes)},
                    key=[*session_key(df), "artifact_id"])
    reads = reads.where(F.contains("rw", F.lit("r")) & F.col("src").isNotNull())
    edges = _edges(chain, "next").unionByName(_edges(reads, "artifact"))
    return nodes, edges


def _edges(rows: DataFrame, kind: str) -> DataFrame:
    return rows.select("session_id", "src", F.col("step_id").alias("dst"), F.lit(kind).alias("edge_kind"))


def link_findings(nodes: DataFrame, findings: DataFrame) -> DataFrame:
    """Nodes with the local findings that bear on them."""
    local = findings.where("step_id is not null").groupBy("session_id", "step_id").agg(
        F.count("*").alias("n_findings"), F.max("severity").alias("severity"),
        F.array_sort(F.collect_set("rule_id")).alias("rules"))
    return nodes.join(local, ["session_id", "step_id"], "left").withColumn(
        "n_findings", F.coalesce("n_findings", F.lit(0)))


def symptoms(df: DataFrame, feedback: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """Where trouble shows: explicit errors, feedback, and sessions found by outcome (``hits``).

    Feedback that names no step and outcome hits are put on the session's last step.
    """
    shown = df.where(~F.coalesce("ok", F.lit(True))).select(
        "session_id", "step_id", F.col("step").cast("int").alias("step"), F.lit("error").alias("source"))
    last = df.groupBy("session_id").agg(F.max(F.struct("step", "step_id")).alias("_last"))
    if feedback is not None:
        placed = feedback.where("step_id is not null").join(df.select("session_id", "step_id", "step"), ["session_id", "step_id"])
        whole = feedback.where("step_id is null").select("session_id").distinct().join(last, "session_id")
        shown = shown.unionByName(_symptom(placed, "feedback")).unionByName(_at_last(whole, "feedback"))
    if hits is not None:
        shown = shown.unionByName(_at_last(hits.select("session_id").distinct().join(last, "session_id"), "outcome"))
    return shown.distinct()


def _symptom(rows: DataFrame, source: str) -> DataFrame:
    return rows.select("session_id", "step_id", F.col("step").cast("int").alias("step"), F.lit(source).alias("source"))


def _at_last(rows: DataFrame, source: str) -> DataFrame:
    return _symptom(rows.select("session_id", "_last.step_id", "_last.step"), source)


ROUNDS = 2
LOCAL_EDGES = 100_000       # edges of a session that one task may hold


def trace_back(edges: DataFrame, symptoms: DataFrame, depth: int | None = 5) -> DataFrame:
    """Every step a symptom can be traced back to over at most ``depth`` edges, or over any number with None.

    Keeps the least depth per (symptom, step) and, on it, the smallest path. Sessions of up to ``LOCAL_EDGES`` edges are walked whole, each in a
    task, after one shuffle. Longer ones are walked in rounds of joins on the step, which spreads them. Rows without a session or a step are no symptoms.
    """
    shown = settle(symptoms.where("session_id IS NOT NULL AND step_id IS NOT NULL").groupBy("session_id", F.col("step_id").alias("symptom_id")).agg(
        F.min("step").alias("symptom_step")))
    # Sessions without symptoms are not walked. The edges that are lie in the shared folder, so
    # a lost executor costs no second look at the trace.
    troubled = small_side(settle(shown.select("session_id").distinct()))
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = store(edges.where("src IS NOT NULL AND dst IS NOT NULL").select("session_id", "src", "dst").join(troubled, "session_id", "left_semi"))
    long = settle(steps.groupBy("session_id").count().where(F.col("count") > LOCAL_EDGES).select("session_id"))
    if long.isEmpty():
        return walk_sessions(steps, shown, depth, tasks)
    long = small_side(long)
    near = walk_sessions(steps.join(long, "session_id", "left_anti"), shown.join(long, "session_id", "left_anti"), depth, tasks)
    far = steps.join(long, "session_id", "left_semi").repartition(tasks, "session_id", "dst").distinct()
    return near.unionByName(_in_rounds(store(far), shown.join(long, "session_id", "left_semi"), depth))


def _in_rounds(steps: DataFrame, shown: DataFrame, depth: int | None) -> DataFrame:
    """``trace_back`` by joins. A few rounds make one job; its new rows are settled,
    so the next starts from rows and not from all plans before it. Ends when none are new.
    """
    front = settle(shown.select("session_id", "symptom_id", "symptom_step", F.col("symptom_id").alias("step_id"),
                                F.lit(0).alias("depth"), F.array("symptom_id").alias("path")))
    seen, level = front, 0
    while depth is None or level < depth:
        upto = level + ROUNDS if depth is None else min(level + ROUNDS, depth)
        rounds = [front]
        for at in range(level + 1, upto + 1):
            rounds.append(_one_back(rounds[-1], steps, at))
        near = reduce(DataFrame.unionByName, rounds[1:]).groupBy("session_id", "symptom_id", "symptom_step", "step_id").agg(
            F.min(F.struct("depth", "path")).alias("_way"))
        fresh = settle(near.select("session_id", "symptom_id", "symptom_step", "step_id", "_way.depth", "_way.path").join(
            seen.select("session_id", "symptom_id", "step_id"), ["session_id", "symptom_id", "step_id"], "left_anti"))
        seen, level = seen.unionByName(fresh), upto
        front = fresh.where(F.col("depth") == upto)
        if (depth is None or level < depth) and front.isEmpty():
            break
    return seen


def _one_back(front: DataFrame, steps: DataFrame, depth: int) -> DataFrame:
    reached = front.withColumnRenamed("step_id", "dst").join(steps, ["session_id", "dst"])
    return reached.groupBy("session_id", "symptom_id", "symptom_step", F.col("src").alias("step_id")).agg(
        F.min(F.array_append("path", F.col("src"))).alias("path")).withColumn("depth", F.lit(depth))


def propagation(back: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stages on the way from each traced step to its symptom, equal neighbours as one."""
    way = back.select("session_id", "symptom_id", "step_id", "depth", "path", F.posexplode("path").alias("_at", "_node"))
    stages = nodes.select("session_id", F.col("step_id").alias("_node"), "stage")
    named = way.join(stages, ["session_id", "_node"]).groupBy("session_id", "symptom_id", "step_id", "depth").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_at")).alias("at"), F.coalesce("stage", F.lit("?")).alias("stage")))),
                    lambda r: r["stage"]).alias("_all"))
    kept = F.filter("_all", lambda s, i: (i == 0) | (s != F.get("_all", i - 1)))
    return named.select("session_id", "symptom_id", "step_id", "depth", kept.alias("stages"))
