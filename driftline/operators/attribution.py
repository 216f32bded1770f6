"""From symptoms to critical steps, causes, missed gates and reports."""

from __future__ import annotations

from pyspark.accumulators import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import seconds_between
from driftline.functions.ordered import carried, last_known, last_rows, previous, running
from driftline.functions.quantile import quantiles, sketched_quantiles, value_sketches
from driftline.functions.sizing import settle, small_side, store
from driftline.operators.nearest import nearest

# How much each reason weighs when causes are ranked.
WEIGHTS = {"reach": 0.4, "severity": 0.3, "earliness": 0.2, "lift": 0.1}


def critical_step(findings: DataFrame, symptoms: DataFrame) -> DataFrame:
    """For each symptom the earliest deviation at or before it.

    That is the session's first deviation if it is early enough and none otherwise, so a
    row per session is enough and steps are not compared pairwise.
    """
    first = findings.where("step is not null").groupBy("session_id").agg(
        F.min(F.struct("step", "step_id", "rule_id", "rule_kind", "stage")).alias("_first"))
    shown = symptoms.select("session_id", F.col("step_id").alias("symptom_id"), F.col("step").alias("symptom_step")).distinct()
    return shown.join(first, "session_id").where(F.col("_first.step") <= F.col("symptom_step")).select(
        "session_id", "symptom_id", "symptom_step", F.col("_first.step").alias("first_step"),
        F.col("_first.step_id").alias("first_step_id"), F.col("_first.rule_id").alias("rule_id"),
        F.col("_first.rule_kind").alias("rule_kind"), F.col("_first.stage").alias("stage"))


def candidate_causes(back: DataFrame, findings: DataFrame, k: int, lift: DataFrame | None = None,
                     weights: dict[str, float] | None = None) -> DataFrame:
    """The ``k`` best candidates per symptom among the findings on its way back.

    Nearness on the graph, severity, earliness and (given ``lift``, the impact of events) how
    much more often runs with that event fail are weighed together. Candidates of one symptom are
    bounded by the depth of the walk.
    """
    w = weights or WEIGHTS
    local = findings.where("step_id is not null").select("session_id", "step_id", "step", "stage", "rule_id", "rule_kind", "severity")
    found = back.select("session_id", "symptom_id", "symptom_step", "step_id", "depth").join(local, ["session_id", "step_id"])
    if lift is not None:
        found = found.join(small_side(settle(lift.select(F.col("name").alias("stage"), "rate_with", "rate_without"))), "stage", "left")
    else:
        found = found.withColumns({c: F.lit(None).cast("double") for c in ("rate_with", "rate_without")})
    # lift / (1 + lift), also where no run without the event failed
    lift_part = F.coalesce(F.try_divide("rate_with", F.col("rate_with") + F.col("rate_without")), F.lit(0.0))
    score = (F.lit(w["reach"]) / (1 + F.col("depth")) + F.lit(w["severity"]) * F.col("severity")
             + F.lit(w["earliness"]) * (F.col("symptom_step") - F.col("step")) / F.col("symptom_step")
             + F.lit(w["lift"]) * lift_part)
    found = found.withColumn("score", F.round(score, 9))
    best = Window.partitionBy("session_id", "symptom_id").orderBy(F.desc("score"), "step", "rule_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).select(
        "session_id", "symptom_id", "place", "step_id", "step", "depth", "stage", "rule_id", "rule_kind", "score")


def missed_gates(gates: DataFrame, critical: DataFrame) -> DataFrame:
    """For each symptom the first gate after the first deviation, not after it, that let the run pass."""
    begun = critical.groupBy("session_id").agg(F.min("first_step").alias("_begun"))
    let_by = gates.where("passed").join(begun, "session_id").where(F.col("step") > F.col("_begun"))
    first = let_by.groupBy("session_id").agg(F.min(F.struct("step", "step_id", "gate")).alias("_gate"))
    return critical.join(first, "session_id").where(F.col("_gate.step") <= F.col("symptom_step")).select(
        "session_id", "symptom_id", F.col("_gate.step_id").alias("gate_step_id"), F.col("_gate.step").alias("gate_step"),
        F.col("_gate.gate").alias("gate"))


def gate_stats(gates: DataFrame, critical: DataFrame) -> DataFrame:
    """Per gate: chances to stop a deviation before a symptom, how many it missed, and the share."""
    spans = critical.groupBy("session_id").agg(F.min("first_step").alias("_begun"), F.max("symptom_step").alias("_ended"))
    chances = gates.join(spans, "session_id").where(
        (F.col("step") > F.col("_begun")) & (F.col("step") <= F.col("_ended")))
    return chances.groupBy("gate").agg(
        F.count("*").alias("chances"), F.count_if("passed").alias("misses")).withColumn(
        "miss_share", F.col("misses") / F.col("chances"))


def event_impact(df: DataFrame, outcome: DataFrame) -> DataFrame:
    """Failure rate of sessions with an event against those without it, from recorded runs alone."""
    held = df.select("session_id", "name").distinct().join(
        outcome.select("session_id", (~F.col("good")).cast("int").alias("_failed")), "session_id")
    with_it = held.groupBy("name").agg(F.count("*").alias("n_with"), F.sum("_failed").alias("failed_with"))
    every = outcome.agg(F.count("*").alias("n"), F.count_if(~F.col("good")).alias("failed")).first()
    n, failed = F.lit(every["n"]), F.lit(every["failed"])
    rates = with_it.withColumns({
        "rate_with": F.col("failed_with") / F.col("n_with"),
        "rate_without": F.try_divide(failed - F.col("failed_with"), n - F.col("n_with")),
    })
    return rates.select(
        "name", "n_with", "failed_with", (F.col("n_with") / n).alias("support"), "rate_with", "rate_without",
        (F.col("rate_with") - F.col("rate_without")).alias("difference"),
        F.try_divide("rate_with", "rate_without").alias("lift"))


def error_lookback(df: DataFrame, k: int) -> DataFrame:
    """Each explicit error with up to ``k`` steps before it, oldest first."""
    step = F.struct("step_id", "step", "name")
    return running(df, {"before": last_rows(step, k)}).where(~F.coalesce("ok", F.lit(True))).select(
        *carried(df), "step_id", "step", "before")


def decision_context(df: DataFrame) -> DataFrame:
    """Each action with the latest cognition row before it."""
    thought = F.when(F.col("layer") == "cognition", F.struct("step_id", "name"))
    return running(df, {"_thought": last_known(thought)}).where("kind = 'action'").select(
        *carried(df), "step_id", "step", "name", F.col("_thought.step_id").alias("thought_step_id"),
        F.col("_thought.name").alias("thought_name"))


def vote(verdicts: DataFrame, quorum: int) -> DataFrame:
    """Verdict of several verifiers per finding: one with most votes and at least ``quorum``, else split."""
    kinds = ["confirm", "correct", "insufficient"]
    counts = verdicts.groupBy("finding_id").agg(
        F.count("*").alias("n_votes"), *[F.count_if(F.col("verdict") == v).alias(v) for v in kinds])
    top = F.greatest(*kinds)
    alone = sum(((F.col(v) == top).cast("int") for v in kinds), F.lit(0)) == 1
    winner = F.when(alone & (top >= quorum), F.coalesce(*[F.when(F.col(v) == top, F.lit(v)) for v in kinds]))
    return counts.withColumn("decision", F.coalesce(winner, F.lit("split")))


def recall_cases(findings: DataFrame, memory: DataFrame, k: int, at: str = "version") -> DataFrame:
    """The ``k`` most frequent resolved causes of earlier cases with a finding's ``signature``.

    Earlier means a smaller ``at`` than the finding's; cases without a cause do not count. The memory shrinks to counts per
    signature, time and cause, and these are summed once per signature and time asked for, so a common
    failure does not meet every past case of its kind.
    """
    causes = memory.where("cause IS NOT NULL").groupBy("signature", F.col(at).alias("_then"), "cause").agg(F.count("*").alias("_n"))
    asked = findings.select("signature", at).distinct()
    known = asked.join(causes, "signature").where(F.col("_then") < F.col(at)).groupBy("signature", at, "cause").agg(F.sum("_n").alias("cases"))
    best = Window.partitionBy("signature", at).orderBy(F.desc("cases"), "cause")
    known = known.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    return findings.join(small_side(settle(known)), ["signature", at])


def recall_near(queries: DataFrame, memory: DataFrame, k: int, dim: int, compared: Accumulator | None = None) -> DataFrame:
    """The ``k`` resolved earlier cases most like a query, by exact cosine at nine digits, then case_id.

    ``queries`` have query_id, at and vector, ``memory`` case_id, at, vector and cause. Only cases before the query's ``at`` and with
    a cause count. No such case is lost: see ``nearest`` for what is ruled out, and for odd rows. ``compared`` is told how many pairs were not.
    """
    vector = {d: F.col("vector") if d.schema["vector"].dataType.simpleString() == "array<float>" else F.col("vector").cast("array<double>") for d in (queries, memory)}
    asked = queries.select("query_id", F.col("at").alias("_now"), vector[queries].alias("_q"))
    past = memory.where("cause IS NOT NULL").select("case_id", F.col("at").alias("_then"), "cause", vector[memory].alias("_v"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "case_id"))
    return nearest(asked, past, k, dim, compared).withColumn("place", place).where(F.col("place") <= k)


def attribution_report(symptoms: DataFrame, critical: DataFrame, causes: DataFrame, missed: DataFrame) -> DataFrame:
    """One row per session with symptoms: first deviation, best cause, missed gate, and a sentence."""
    shown = symptoms.groupBy("session_id").agg(F.countDistinct("step_id").alias("symptoms"))
    first = critical.groupBy("session_id").agg(
        F.min(F.struct("first_step", "first_step_id", "rule_id")).alias("first"))
    best = causes.where("place = 1").groupBy("session_id").agg(
        F.min(F.struct((-F.col("score")).alias("far"), "step", "rule_id", "step_id")).alias("_best"))
    gate = missed.groupBy("session_id").agg(F.min(F.struct("gate_step", "gate_step_id", "gate")).alias("_gate"))
    out = shown.join(first, "session_id", "left").join(best, "session_id", "left").join(gate, "session_id", "left")
    sentence = F.format_string(
        "%s: %d symptom(s); first deviation %s; likely cause %s; missed gate %s", F.col("session_id"), F.col("symptoms"),
        F.coalesce("first.rule_id", F.lit("none")), F.coalesce("_best.rule_id", F.lit("none")),
        F.coalesce("_gate.gate", F.lit("none")))
    return out.select(
        "session_id", "symptoms", F.col("first.first_step_id").alias("first_step_id"), F.col("_best.rule_id").alias("cause"),
        F.col("_best.step_id").alias("cause_step_id"), F.col("_gate.gate").alias("gate"),
        F.col("_gate.gate_step_id").alias("gate_step_id"), sentence.alias("sentence"))


def flow_moves(df: DataFrame) -> DataFrame:
    """Moves from stage to stage with their seconds, and the version of the run where rows have one."""
    moves = running(df, {"before": previous("stage"), "_ts": previous("ts")}).where("before is not null")
    return moves.select(*[c for c in ("version",) if c in df.columns], "before", "stage", seconds_between(F.col("_ts"), F.col("ts")).alias("seconds"))


def flow_view(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Stage to stage moves with their count and exact median seconds, null where no move has a time."""
    moves = store(flow_moves(df).select("before", "stage", "seconds"))
    return _flow(moves, quantiles(moves, ["before", "stage"], "seconds", {"median_seconds": 0.5}, max_rows))


def flow_sketches(moves: DataFrame) -> DataFrame:
    """What is kept of the seconds of a version's moves; see ``value_sketches``."""
    return value_sketches(moves, ["version", "before", "stage"], "seconds")


def flow_view_over(sketches: DataFrame, moves: DataFrame) -> DataFrame:
    """``flow_view`` of the ``flow_moves`` of a span of versions, bracketed by the sketches kept of these versions."""
    return _flow(moves, sketched_quantiles(sketches, moves, ["before", "stage"], "seconds", {"median_seconds": 0.5}))


def _flow(moves: DataFrame, middles: DataFrame) -> DataFrame:
    counts = moves.groupBy("before", "stage").agg(F.count("*").alias("n"))
    # Moves into a null stage or without times keep their count.
    same = F.struct("before", "stage") == F.col("_at")
    return counts.join(middles.select(F.struct("before", "stage").alias("_at"), "median_seconds"), same, "left").drop("_at")
