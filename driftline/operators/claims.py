"""What a run says it did against what its records show."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.ordered import SEG, carried, last_known, running, session_key
from driftline.operators.fingerprints import quoted


def claims(df: DataFrame, names: list[str] | None = None, pattern: str | None = None,
           text: str = "text") -> DataFrame:
    """Rows that claim completion, by event name or by the pattern of their text."""
    tests = []
    if names:
        tests.append(F.col("name").isin(names))
    if pattern:
        tests.append(F.col(text).rlike(pattern))
    if not tests:
        raise ValueError("give names, a pattern or both")
    return df.where(reduce(Column.__or__, tests))


def evidence(df: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """Rows that prove something, once per kind (trace, command, diff) whose test they meet."""
    met = F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in kinds.items()]))
    return df.withColumn("evidence_kind", F.explode(met))


def check_claims(df: DataFrame, claim: Column, kinds: dict[str, Column], within: str | None = None) -> DataFrame:
    """``claim_support`` where claims and evidence are rows of one trace: a single window over it."""
    met = F.array_max(F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in kinds.items()])))
    proof = F.when(met.isNotNull(), F.struct("ts", "step_id", met.alias("kind")))
    told = running(df, {"_proof": last_known(proof)}).where(claim)
    return _supported(told, carried(df), within)


def claim_support(claims: DataFrame, evidence: DataFrame, within: str | None = None) -> DataFrame:
    """Each claim with the latest evidence strictly before it in its session.

    One running pass over both tables, so a session's claims never meet its evidence pairwise.
    ``within`` asks for evidence no older than an interval; the latest one decides that too.
    """
    key = session_key(claims)
    cut = [SEG] if SEG in claims.columns else []
    told = claims.select(*key, *cut, "ts", "step_id", F.lit(0).alias("_is_proof"), F.lit(None).cast("string").alias("_kind"))
    proofs = evidence.select(*key, *cut, "ts", "step_id", F.lit(1).alias("_is_proof"), F.col("evidence_kind").alias("_kind"))
    proof = F.when(F.col("_is_proof") == 1, F.struct("ts", "step_id", F.col("_kind").alias("kind")))
    both = running(told.unionByName(proofs), {"_proof": last_known(proof)}, key=key,
                   order=["ts", "step_id", "_is_proof", "_kind"])
    return _supported(both.where("_is_proof = 0"), [*key, *cut], within)


def _supported(told: DataFrame, keep: list[str], within: str | None) -> DataFrame:
    held = F.col("_proof").isNotNull()
    if within:
        held = held & (F.col("ts") - F.col("_proof.ts") <= F.expr(f"interval {within}"))
    return told.select(
        *keep, "ts", "step_id", F.when(held, F.col("_proof.step_id")).alias("evidence_step_id"),
        F.when(held, F.col("_proof.kind")).alias("evidence_kind"),
        F.when(held, "supported").otherwise("unsupported").alias("status"))


def false_success(claims: DataFrame, env: DataFrame, key: str, done: Column) -> DataFrame:
    """Each claim against the final environment rows under its ``key``.

    ``supported`` when all rows satisfy ``done``, ``contradicted`` when one does not,
    ``missing`` when there are none. The environment shrinks to a row per key first.
    """
    state = env.groupBy(key).agg(F.count("*").alias("rows"), F.count_if(~done).alias("against"))
    return claims.join(state, key, "left").withColumn(
        "status", F.when(F.col("rows").isNull(), "missing").when(F.col("against") > 0, "contradicted")
        .otherwise("supported")).drop("rows", "against")


def silent_failures(df: DataFrame, outcome: DataFrame) -> DataFrame:
    """Sessions without an explicit error whose outcome (``good``) is wrong."""
    quiet = df.groupBy(*session_key(df)).agg(
        F.count("*").alias("n_rows"), F.count_if(~F.coalesce("ok", F.lit(True))).alias("errors")).where("errors = 0")
    return quiet.drop("errors").join(outcome.where(~F.col("good")), "session_id", "left_semi")


def attach_evidence(findings: DataFrame, evidence: DataFrame) -> DataFrame:
    """Findings with references to the latest evidence of each kind up to their step.

    The list holds one reference per kind, so it stays short in sessions of any length.
    """
    key = session_key(findings)
    cut = [SEG] if SEG in findings.columns else []
    kinds = ["trace", "command", "diff"]
    given = findings.withColumn("_turn", F.lit(1)).withColumn("_kind", F.lit(None).cast("string"))
    proofs = evidence.select(*key, *cut, "step_id", "step", F.lit(0).alias("_turn"), F.col("evidence_kind").alias("_kind"))
    both = given.unionByName(proofs, allowMissingColumns=True)
    seen = running(both, {
        f"_last_{k}": last_known(F.when(F.col("_kind") == k, F.struct(
            "session_id", "step_id", F.col("_kind").alias("kind")))) for k in kinds
    }, key=key, order=["step", "_turn", "step_id"])
    # A finding on a whole session has no step: order puts it first and it gets no reference.
    refs = F.array_sort(F.array_compact(F.array(*[f"_last_{k}" for k in kinds])))
    return seen.where("_turn = 1").withColumn("evidence", refs).drop("_turn", "_kind", *[f"_last_{k}" for k in kinds])


def cites(texts: DataFrame, passages: DataFrame, text_id: str, passage_id: str) -> DataFrame:
    """Which texts hold which passages literally, each pair of ids once.

    Texts are searched whole for the marks of the passages and confirmed; see ``fingerprints``. Null and empty
    texts and passages hold and are nothing.
    """
    return quoted(texts, passages, text_id, passage_id)
