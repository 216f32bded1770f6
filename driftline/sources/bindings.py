"""The given tables seen as traces, claims, environment, verdicts and cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.ordered import last_known, running, segment, session_key
from driftline.operators import claims as V
from driftline.operators import normalize as N

# The workflow the event table is read against.
EXPECTED = ["signup", "view", "click", "purchase"]
ORDINALS = {"signup": 1, "view": 2, "click": 3, "purchase": 4}
LAYERS = {"signup": "context", "view": "cognition", "click": "operation", "purchase": "operation",
          "error": "operation"}
GAP_HOURS = 24
GATE_LIMIT = 100.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Canonical column -> SQL expression over the raw event row.
EVENT_MAPPING = {
    "owner": "cast(user_id as string)",
    "step_id": "event_id",
    "ts": "ts",
    "stage": "event_type",
    "kind": "case when event_type in ('view', 'error') then 'event' else 'action' end",
    "name": "event_type",
    "skill": "'signup'",
    "artifact_id": "get_json_object(props, '$.k')",
    "rw": "'rw'",
    "state": "from_json(props, 'map<string,string>')",
    "value": "value",
    "ok": "event_type <> 'error'",
    "version": "date_format(date_trunc('week', ts), 'yyyy-MM-dd')",
}

CONVERSATION_MAPPING = {
    "session_id": "cast(conv_id as string)",
    "owner": "cast(conv_id as string)",
    "step_id": "turn",
    "step": "cast(turn as int)",
    "stage": "role",
    "kind": "'event'",
    "name": "role",
    "layer": "case when role = 'system' then 'context' else 'operation' end",
    "value": "cast(length(text) as double)",
}


# State with a second field that only rows of at most this value hold.
AMOUNT_STATE = ("map_concat(map('k', get_json_object(props, '$.k')), "
                "if(value <= 100, map('amount', cast(value as string)), cast(map() as map<string,string>)))")


def event_rows(spark: SparkSession, sf_dir: str, **mapping: str) -> DataFrame:
    """Events in canonical columns, long owners cut into pieces, no session yet."""
    rows = N.normalize(table(spark, sf_dir, "events"), {**EVENT_MAPPING, **mapping})
    return segment(rows, ["owner"], ["ts", "step_id"])


def event_trace(spark: SparkSession, sf_dir: str, **mapping: str) -> DataFrame:
    """Events as sessions with layer, task, stage number and step."""
    sessions = N.sessionize(event_rows(spark, sf_dir, **mapping), "owner", f"{GAP_HOURS} hours")
    return N.assign_levels(N.tag_layer(sessions, LAYERS), F.col("name") == "signup")


def slim(trace: DataFrame) -> DataFrame:
    """What the graph and attribution need of a trace."""
    return trace.drop("state", "version", "skill", "task_id", "stage_no", "layer")


def event_claims(trace: DataFrame) -> DataFrame:
    return V.claims(trace, names=["purchase"])


def event_evidence(trace: DataFrame) -> DataFrame:
    """Clicks count as proof of a purchase."""
    return V.evidence(trace, {"trace": F.col("name") == "click"})


def event_proofs(trace: DataFrame) -> DataFrame:
    """All three kinds of evidence, for references."""
    return V.evidence(trace, {"trace": F.col("name") == "click", "command": F.col("name") == "view",
                              "diff": F.col("name") == "signup"})


def event_gates(trace: DataFrame) -> DataFrame:
    """Views act as gates; one lets the run pass while its value is at most the limit."""
    return trace.where(F.col("name") == "view").select(
        *[c for c in ("owner", "session_id", "seg") if c in trace.columns], "step_id", "step",
        F.concat(F.lit("view-"), F.coalesce("artifact_id", F.lit("?"))).alias("gate"),
        (F.col("value") <= GATE_LIMIT).alias("passed"))


def event_support(trace: DataFrame, within: str | None = None) -> DataFrame:
    """Purchases with the latest click before them."""
    return V.check_claims(trace, F.col("name") == "purchase", {"trace": F.col("name") == "click"}, within)


def event_outcome(trace: DataFrame) -> DataFrame:
    """Stand-in outcome per session: wrong when a purchase in it has no click before it."""
    proof = running(trace, {"_proof": last_known(F.when(F.col("name") == "click", F.col("step_id")))})
    unproven = (F.col("name") == "purchase") & F.col("_proof").isNull()
    return proof.groupBy(*session_key(trace)).agg((F.count_if(unproven) == 0).alias("good"))


def event_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case per user and week: passed when at most a fifth of its events are errors."""
    rows = N.normalize(table(spark, sf_dir, "events"), EVENT_MAPPING)
    return rows.groupBy(F.col("owner").alias("case_id"), "version").agg(
        (F.avg(F.when(F.col("ok"), 0.0).otherwise(1.0)) <= 0.2).alias("passed"),
        F.avg("value").alias("score"))


def document_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic verdict on documents: short texts are flagged."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("finding_id"), F.col("source").alias("stratum"), "lang",
        (F.col("n_chars") < 200).alias("flagged"),
        F.when(F.col("n_chars") < 200, "short_text").otherwise("none").alias("cause"),
        (F.col("n_chars") / (F.col("n_chars") + 400.0)).alias("score"))


def document_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two expert passes read from the labels: quality first, toxicity after it."""
    labels = table(spark, sf_dir, "labels")
    first = labels.select(
        F.col("doc_id").cast("string").alias("finding_id"), F.lit("first").alias("reviewer"),
        F.when(F.col("quality") == 0, "correct").otherwise("confirm").alias("verdict"),
        F.when(F.col("quality") == 0, "low_quality").alias("cause"), F.lit(1).alias("round"))
    second = labels.where("toxic = 1").select(
        F.col("doc_id").cast("string").alias("finding_id"), F.lit("second").alias("reviewer"),
        F.when(F.col("quality") == 0, "correct").otherwise("insufficient").alias("verdict"),
        F.when(F.col("quality") == 0, "toxic_text").alias("cause"), F.lit(2).alias("round"))
    return first.unionByName(second)


def document_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three verifiers per labelled document: by length, by quality, by toxicity."""
    both = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(
        table(spark, sf_dir, "labels"), "doc_id")
    votes = F.array(
        F.struct(F.lit("length").alias("reviewer"), _vote(F.col("n_chars") < 200).alias("verdict")),
        F.struct(F.lit("quality").alias("reviewer"), _vote(F.col("quality") == 0).alias("verdict")),
        F.struct(F.lit("toxicity").alias("reviewer"), _vote(F.col("toxic") == 1).alias("verdict")))
    return both.select(F.col("doc_id").cast("string").alias("finding_id"), F.inline(votes))


def _vote(bad):
    return F.when(bad, "correct").otherwise("confirm")
