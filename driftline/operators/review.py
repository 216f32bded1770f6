"""Expert labels: records, verdicts, what to review next, accuracy, dispositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_records(symptoms: DataFrame, critical: DataFrame, nodes: DataFrame, evidence: DataFrame,
                  resolved: DataFrame, missed: DataFrame, disposition: Column) -> DataFrame:
    """One label row per symptom with the seven fields in their fixed order.

    Symptom; violated stage and constraint; key action or event; evidence references;
    cause confirmed by an expert; gate that should have stopped it; final disposition.
    ``evidence`` and ``resolved`` come per symptom; missing parts stay null.
    """
    at = ["session_id", "symptom_id"]
    shown = symptoms.groupBy("session_id", F.col("step_id").alias("symptom_id")).agg(
        F.min("step").alias("step"), F.array_sort(F.collect_set("source")).alias("sources"))
    violated = critical.select(*at, "stage", "rule_id", "first_step_id")
    acts = nodes.select("session_id", F.col("step_id").alias("first_step_id"), "name", "kind")
    rows = (shown.join(violated, at, "left").join(acts, ["session_id", "first_step_id"], "left")
            .join(evidence.select(*at, "evidence"), at, "left")
            .join(resolved.select(*at, "cause", "verdict"), at, "left")
            .join(missed.select(*at, "gate"), at, "left"))
    return rows.select(
        *at, F.struct("step", "sources").alias("symptom"),
        F.struct("stage", F.col("rule_id").alias("constraint")).alias("violated"),
        F.struct(F.col("first_step_id").alias("step_id"), "name", "kind").alias("key_action"), "evidence",
        F.col("cause").alias("confirmed_cause"), F.col("gate").alias("stopping_gate"), disposition.alias("disposition"))


def latest_verdicts(verdicts: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return verdicts.groupBy(*key).agg(
        F.max_by(F.struct("verdict", F.col("cause").alias("expert_cause"), "reviewer"), F.struct(*order, "reviewer")).alias("_v"),
        F.count("*").alias("n_verdicts")).select(*key, "_v.*", "n_verdicts")


def resolve(auto: DataFrame, verdicts: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The automatic ``cause`` overridden by the latest expert verdict.

    ``confirm`` keeps it, ``correct`` replaces it, ``insufficient`` removes it; findings
    nobody reviewed keep it and say so.
    """
    joined = auto.withColumnRenamed("cause", "auto_cause").join(latest_verdicts(verdicts, key, order), key, "left")
    cause = (F.when(F.col("verdict") == "insufficient", F.lit(None).cast("string"))
             .when(F.col("verdict") == "correct", F.col("expert_cause")).otherwise(F.col("auto_cause")))
    return joined.withColumns({"cause": cause, "verdict": F.coalesce("verdict", F.lit("unreviewed")),
                               "n_verdicts": F.coalesce("n_verdicts", F.lit(0))})


def review_queue(findings: DataFrame, n: int, stratum: str = "stratum", score: str = "score",
                 finding_id: str = "finding_id") -> DataFrame:
    """Per stratum the ``n`` findings the score is least sure of, ties by id."""
    doubt = F.abs(F.col(score) - 0.5)
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(doubt, finding_id))
    return findings.withColumn("place", place).where(F.col("place") <= n)


def label_accuracy(auto: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Confusion counts, precision and recall of ``flagged`` against expert ``bad``.

    Labels that are null (insufficient evidence) and findings without a label are counted
    and left out of both shares.
    """
    both = auto.select(key, "flagged").join(labels.select(key, "bad", F.lit(True).alias("_labelled")), key, "full_outer")
    flagged, bad = F.coalesce("flagged", F.lit(False)), F.col("bad")
    counts = both.agg(
        F.count_if(flagged & bad).alias("tp"), F.count_if(flagged & ~bad).alias("fp"),
        F.count_if(~flagged & bad).alias("fn"), F.count_if(~flagged & ~bad).alias("tn"),
        F.count_if(F.col("_labelled") & bad.isNull()).alias("insufficient"),
        F.count_if(F.col("_labelled").isNull()).alias("unreviewed"))
    return counts.withColumns({
        "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))})


def step_hits(candidates: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """Share of symptoms whose confirmed step is among the first k candidates, for each k."""
    at = ["session_id", "symptom_id"]
    right = candidates.join(truth.select(*at, F.col("step_id").alias("_true")), at).where(F.col("step_id") == F.col("_true"))
    first = right.groupBy(*at).agg(F.min("place").alias("_place"))
    all_of = truth.select(*at).join(first, at, "left")
    counts = all_of.agg(F.count("*").alias("n"), *[F.count_if(F.col("_place") <= k).alias(f"_h{k}") for k in ks])
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.col("n"), F.col(f"_h{k}").alias("hits")) for k in ks])
    return counts.select(F.inline(rows)).withColumn("rate", F.try_divide("hits", "n"))


def dispositions(labels: DataFrame) -> DataFrame:
    """Label counts by cause and gate with totals of each and of all."""
    return labels.cube("cause", "gate").agg(
        F.grouping_id().alias("level"), F.count("*").alias("n"), F.count_if(F.col("disposition") == "fixed").alias("fixed"))
