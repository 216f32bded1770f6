"""The three flows: judging a skill, attributing a symptom, and closing the loop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.sizing import settle, store
from driftline.operators import attribution as A
from driftline.operators import checks as C
from driftline.operators import claims as V
from driftline.operators import graph as B
from driftline.operators import normalize as N
from driftline.operators import release as E
from driftline.operators import review as H
from driftline.operators import scoring as G
from driftline.operators import spec as P


@dataclass(frozen=True)
class SkillJudgement:
    windows: DataFrame
    spec: DataFrame
    findings: DataFrame
    scores: DataFrame


def judge_skill(trace: DataFrame, start: Column, theta: float, evidence: dict[str, Column], advice: DataFrame,
                end: Column | None = None, ordinals: dict[str, int] | None = None, spec: DataFrame | None = None,
                skill: str | None = None) -> SkillJudgement:
    """Windows of a skill, its rules (mined unless given), deviations with evidence and advice, and scores."""
    windows = N.skill_windows(trace, start, end)
    # The windows are this skill's, whatever its rows were recorded under.
    windows = store(windows.withColumn("skill", F.lit(skill)) if skill else windows)
    spec = settle(P.extract_spec(windows, theta, skill=skill)) if spec is None else spec
    found = store(C.debug_windows(windows, spec, ordinals))
    proofs = V.evidence(windows, evidence)
    findings = E.suggest(V.attach_evidence(found, proofs), advice)
    return SkillJudgement(windows, spec, findings, G.skill_scores(found, windows))


@dataclass(frozen=True)
class Attribution:
    nodes: DataFrame
    edges: DataFrame
    symptoms: DataFrame
    back: DataFrame
    chains: DataFrame
    critical: DataFrame
    causes: DataFrame
    missed: DataFrame
    gates: DataFrame
    reports: DataFrame


def attribute(trace: DataFrame, findings: DataFrame, gates: DataFrame, feedback: DataFrame | None = None,
              hits: DataFrame | None = None, impact: DataFrame | None = None, depth: int = 5, k: int = 3) -> Attribution:
    """From symptoms over the session graph to first deviation, causes, missed gates and reports.

    Give a ``trace`` and ``findings`` that are stored or read from tables: several steps scan them.
    """
    nodes, edges = B.build_graph(trace)
    nodes = B.link_findings(nodes, findings)
    shown = settle(B.symptoms(trace, feedback, hits))
    back = B.trace_back(edges, shown, depth)
    critical = settle(A.critical_step(findings, shown))
    causes = settle(A.candidate_causes(back, findings, k, impact))
    missed = A.missed_gates(gates, critical)
    return Attribution(
        nodes=nodes, edges=edges, symptoms=shown, back=back, chains=B.propagation(back, nodes), critical=critical,
        causes=causes, missed=missed, gates=A.gate_stats(gates, critical),
        reports=A.attribution_report(shown, critical, causes, missed))


@dataclass(frozen=True)
class LoopRound:
    resolved: DataFrame
    hard: DataFrame
    evalset: DataFrame
    metrics: DataFrame
    gate: DataFrame
    changes: DataFrame
    routes: DataFrame


def close_loop(auto: DataFrame, verdicts: DataFrame, votes: DataFrame, routing: DataFrame, base: DataFrame,
               cand: DataFrame, floors: dict[str, float], quorum: int, order: list[str]) -> LoopRound:
    """Verdicts into sets and routes; two versions' results on the sets into metrics and a gate.

    ``auto`` and the results share their ids: a finding is a case.
    """
    resolved = store(H.resolve(auto, verdicts, ["finding_id"], order))
    hard = E.hard_cases(resolved, A.vote(votes, quorum))
    evalset = store(E.assign_sets(resolved.select(F.col("finding_id").alias("case_id")),
                                  hard.select(F.col("finding_id").alias("case_id"))))
    both = base.withColumn("version", F.lit("base")).unionByName(cand.withColumn("version", F.lit("candidate")))
    known = evalset.select("case_id")
    tried, before = cand.join(known, "case_id", "left_semi"), base.join(known, "case_id", "left_semi")
    return LoopRound(
        resolved=resolved, hard=hard, evalset=evalset, metrics=E.offline_eval(both, evalset),
        gate=E.release_gate(before, tried, floors), changes=E.case_diff(before, tried),
        routes=E.route_fix(resolved, routing))
