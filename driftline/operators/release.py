"""Evaluation sets, offline evaluation, the release gate and what comes after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.sizing import small_side

METRICS = {
    "pass_rate": lambda: F.avg(F.col("_now").cast("double")),
    "mean_score": lambda: F.avg("_score"),
}


def curate(cases: DataFrame, case_id: str = "case_id") -> DataFrame:
    """One reusable case per signature among the resolved ones, the first by id, with how many it stands for."""
    kept = cases.where("cause is not null").groupBy("signature").agg(
        F.min_by(F.struct(*[c for c in cases.columns if c != "signature"]), F.col(case_id)).alias("_c"),
        F.count("*").alias("stands_for"))
    return kept.select("signature", "_c.*", "stands_for")


def hard_cases(resolved: DataFrame, votes: DataFrame, key: str = "finding_id") -> DataFrame:
    """Findings where the expert corrected the automatic cause or the verifiers split."""
    split = votes.where("decision = 'split'").select(key, F.lit(True).alias("split"))
    both = resolved.select(key, "auto_cause", "cause", "verdict").join(split, key, "left")
    differs = (F.col("verdict") == "correct") & ~F.col("cause").eqNullSafe(F.col("auto_cause"))
    return both.withColumns({"disagrees": differs, "split": F.coalesce("split", F.lit(False))}).where("disagrees or split")


def assign_sets(cases: DataFrame, hard: DataFrame, key: str = "case_id", test_share: int = 20,
                number: Column | None = None) -> DataFrame:
    """Each case in exactly one set, hard or golden, and in a split that never changes for its id."""
    number = number if number is not None else F.xxhash64(key)
    marked = cases.join(hard.select(key, F.lit(True).alias("_hard")).distinct(), key, "left")
    return marked.withColumns({
        "set_name": F.when(F.col("_hard"), "hard").otherwise("golden"),
        "split": F.when(F.pmod(number, F.lit(100)) < test_share, "test").otherwise("train"),
    }).drop("_hard")


def offline_eval(results: DataFrame, evalset: DataFrame) -> DataFrame:
    """Pass rate and mean score per set and version, per version, and overall.

    Results shrink to a row per case and version before they meet the set.
    """
    runs = results.groupBy("case_id", "version").agg(
        F.count("*").alias("n"), F.count("passed").alias("n_judged"), F.count_if("passed").alias("n_passed"),
        F.count("score").alias("n_scored"), F.sum("score").alias("sum_score"))
    rows = runs.join(evalset.select("case_id", "set_name"), "case_id")
    sets = [["set_name", "version"], ["version"], []]
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], "set_name", "version").agg(
        F.grouping_id().alias("level"), F.sum("n").alias("n"),
        F.try_divide(F.sum("n_passed"), F.sum("n_judged")).alias("pass_rate"),
        F.try_divide(F.sum("sum_score"), F.sum("n_scored")).alias("mean_score"))


def _paired(base: DataFrame, cand: DataFrame) -> DataFrame:
    was = base.select("case_id", F.col("passed").alias("_was"), F.lit(True).alias("_in_base"))
    now = cand.select("case_id", F.col("passed").alias("_now"), F.col("score").alias("_score"), F.lit(True).alias("_in_cand"))
    return was.join(now, "case_id", "full_outer")


def release_gate(base: DataFrame, cand: DataFrame, floors: dict[str, float]) -> DataFrame:
    """One row: the candidate's metrics, cases passed before that do not pass now, and whether it may go out.

    A passed case that the candidate did not run, or left undecided, counts as a regression.
    """
    seen = _paired(base, cand).agg(
        *[METRICS[m]().alias(m) for m in floors],
        F.count_if(F.col("_was") & ~F.coalesce("_now", F.lit(False))).alias("regressions"),
        F.count_if(F.col("_in_base") & F.col("_in_cand").isNull()).alias("not_run"))
    met = F.lit(True)
    for m, floor in floors.items():
        met = met & F.coalesce(F.col(m) >= floor, F.lit(False))
    return seen.withColumns({"floors_met": met, "accepted": met & (F.col("regressions") == 0)})


def case_diff(base: DataFrame, cand: DataFrame) -> DataFrame:
    """Cases that changed between two versions.

    ``new`` and ``gone``: only one version holds the case. ``regressed`` and ``fixed``: both decided it, differently. ``undecided``: it
    passed before and the candidate left it open, which the gate counts as a regression too. ``reopened``: it failed before and is open now;
    ``settled``: it was open before and is decided now.
    """
    was, now = F.col("_was"), F.col("_now")
    change = (F.when(F.col("_in_base").isNull(), "new").when(F.col("_in_cand").isNull(), "gone")
              .when(was & ~now, "regressed").when(~was & now, "fixed")
              .when(was & now.isNull(), "undecided").when(~was & now.isNull(), "reopened").when(was.isNull() & now.isNotNull(), "settled"))
    return _paired(base, cand).select("case_id", change.alias("change")).where("change is not null")


def accepted(gate: DataFrame, ledger: DataFrame, key: str = "version") -> DataFrame:
    """Versions that passed the gate and that someone accepted."""
    return gate.where("accepted").join(ledger.where("decision = 'accept'"), key, "left_semi")


def round_trend(metrics: DataFrame) -> DataFrame:
    """Each metric with its value in the round before and the change."""
    rounds = Window.partitionBy("metric").orderBy("version")
    return metrics.withColumn("before", F.lag("value").over(rounds)).withColumn("change", F.col("value") - F.col("before"))


def route_fix(causes: DataFrame, routing: DataFrame, cause: str = "cause") -> DataFrame:
    """Confirmed causes counted by the kind of thing to change; unknown causes are kept apart."""
    counts = causes.groupBy(F.col(cause).alias("cause")).agg(F.count("*").alias("n"))
    return counts.join(small_side(routing), "cause", "left").groupBy(
        F.coalesce("target", F.lit("unrouted")).alias("target")).agg(
        F.sum("n").alias("n"), F.count("*").alias("causes"))


def suggest(findings: DataFrame, advice: DataFrame) -> DataFrame:
    """Findings with the advice for their kind of rule."""
    return findings.join(small_side(advice), "rule_kind", "left").withColumn(
        "advice", F.coalesce("advice", F.lit("look at the step")))


def assertions(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Named predicates over rows (sessions, say): passed, failed and undecided counts in one pass."""
    counts = df.agg(F.count("*").alias("_n"), *[
        c for i, e in enumerate(exprs.values())
        for c in (F.count_if(F.expr(e)).alias(f"_p{i}"), F.count_if(~F.expr(e)).alias(f"_f{i}"))])
    rows = F.array(*[F.struct(F.lit(name).alias("assertion"), F.col(f"_p{i}").alias("passed"), F.col(f"_f{i}").alias("failed"),
                              (F.col("_n") - F.col(f"_p{i}") - F.col(f"_f{i}")).alias("undecided"))
                     for i, name in enumerate(exprs)])
    return counts.select(F.inline(rows))


def intervention_effect(runs: DataFrame, match: list[str]) -> DataFrame:
    """Success of recorded runs with an intervention against matched runs without it, per hypothesis.

    Rates are compared within groups equal on ``match`` and averaged by their number of
    runs with the intervention; groups without both arms are counted, not compared.
    """
    with_it, good = F.col("arm") == "with", F.col("good").cast("double")
    groups = runs.groupBy("hypothesis", *match).agg(
        F.count_if(with_it).alias("n1"), F.count_if(~with_it).alias("n0"),
        F.avg(F.when(with_it, good)).alias("r1"), F.avg(F.when(~with_it, good)).alias("r0"))
    paired = (F.col("n1") > 0) & (F.col("n0") > 0)
    weight = F.when(paired, F.col("n1"))
    return groups.groupBy("hypothesis").agg(
        F.sum("n1").alias("n_with"), F.sum("n0").alias("n_without"), F.count_if(~paired).alias("unmatched_groups"),
        F.try_divide(F.sum(weight * (F.col("r1") - F.col("r0"))), F.sum(weight)).alias("effect"))
