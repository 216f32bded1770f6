"""Scores of steps, windows, sessions and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import ordinal_of
from driftline.functions.ordered import last_rows, previous, run_key, running, running_max, session_key
from driftline.functions.quantile import median_and_mad
from driftline.functions.sizing import settle, small_side, store
from driftline.operators.checks import ruled


def output_scores(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Share of its stage's expectations (required fields and value ranges) that each step meets.

    Rules that name a skill are asked of its rows, others of all. Steps nothing is asked of keep their row, with a null score.
    """
    rules = spec.where("rule_kind IN ('required_field', 'range')").where("rule_kind <> 'range' OR lo IS NOT NULL OR hi IS NOT NULL")
    rows = ruled(df, rules)
    met = F.size(F.filter("_required", lambda f: F.col("state")[f].isNotNull())) + F.size(F.filter("_ranges", lambda r: F.coalesce(
        (F.col("value") >= F.coalesce(r["lo"], F.col("value"))) & (F.col("value") <= F.coalesce(r["hi"], F.col("value"))), F.lit(False))))
    return rows.withColumns({"expected": F.size("_required") + F.size("_ranges"), "met": met}).withColumn(
        "score", F.try_divide("met", "expected")).drop("_for_all", "_own", "_required", "_ranges", "_allowed")


def progress_steps(df: DataFrame, ordinals: dict[str, int]) -> DataFrame:
    """Per step +1 for reaching further than before, -1 for falling back, else 0."""
    placed = running(df.withColumn("_ord", ordinal_of("stage", ordinals)), {"_peak": running_max("_ord")})
    move = F.signum(F.col("_ord") - F.coalesce("_peak", F.lit(0)))
    return placed.withColumn("progress", F.coalesce(move, F.lit(0)).cast("int")).drop("_ord", "_peak")


def progress_scores(df: DataFrame, ordinals: dict[str, int]) -> DataFrame:
    """Sum of step progress per session."""
    return progress_steps(df, ordinals).groupBy(*session_key(df)).agg(
        F.sum("progress").alias("progress"), F.count("*").alias("n_rows"))


def skill_scores(findings: DataFrame, windows: DataFrame) -> DataFrame:
    """Score per skill window: one less its summed severity, zero at the worst."""
    key = run_key(windows)
    lost = findings.groupBy(*key).agg(F.sum("severity").alias("_lost"), F.count("*").alias("n_findings"))
    ran = windows.select(*key).distinct()
    return ran.join(lost, key, "left").select(
        *key, F.coalesce("n_findings", F.lit(0)).alias("n_findings"),
        (1 - F.least(F.lit(1.0), F.coalesce("_lost", F.lit(0.0)))).alias("score"))


def trajectory_surprise(df: DataFrame) -> DataFrame:
    """Mean of -ln p(next | previous) per session, p being the corpus share of the transition.

    Moves are counted per session once; the shares are sums of those counts. A null stage is a stage like others.
    """
    moves = running(df, {"before": previous("stage")}).where("before is not null")
    moves = store(moves.groupBy(*session_key(df), "before", "stage").agg(F.count("*").alias("_n")))
    counts = moves.groupBy("before", "stage").agg(F.sum("_n").alias("n"))
    support = F.col("n") / F.sum("n").over(Window.partitionBy("before"))
    cost = small_side(settle(counts.select(F.struct("before", "stage").alias("_at"), (-F.log(support)).alias("_cost"))))
    return moves.join(cost, F.struct("before", "stage") == F.col("_at")).groupBy(*session_key(df)).agg(
        (F.sum(F.col("_cost") * F.col("_n")) / F.sum("_n")).alias("surprise"), F.sum("_n").alias("moves"))


def _contexts(df: DataFrame, depth: int) -> DataFrame:
    """(keys, past, stage, n): how often a session takes a stage after up to ``depth`` stages, the nearest first; unknown ones end the past."""
    rows = running(df, {"_rows": last_rows("stage", depth)}).withColumn("_past", F.reverse("_rows"))
    unknown = F.array_position(F.transform("_past", lambda s: s.isNull()), F.lit(True)).cast("int")
    past = F.when(unknown > 0, F.slice("_past", F.lit(1), unknown - 1)).otherwise(F.col("_past"))
    counted = rows.select(*session_key(df), past.alias("past"), "stage").where(F.size("past") > 0)
    return store(counted.groupBy(*session_key(df), "past", "stage").agg(F.count("*").alias("n")))


def _tree(moves: DataFrame, depth: int, least_gain: float) -> DataFrame:
    whole = moves.groupBy("past", "stage").agg(F.sum("n").alias("n"))
    each = F.explode(F.transform(F.sequence(F.lit(1), F.least(F.size("past"), F.lit(depth))), lambda k: F.slice("past", 1, k))).alias("context")
    counts = whole.select("stage", "n", each).groupBy("context", "stage").agg(F.sum("n").alias("n"))
    shares = store(counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("context"))))
    # A context stays if it tells enough more than the one without its oldest stage.
    above = shares.select(F.struct("context", "stage").alias("_of"), F.col("p").alias("_p"))
    shorter = F.struct(F.slice("context", F.lit(1), F.size("context") - 1).alias("context"), F.col("stage"))
    gains = shares.where(F.size("context") > 1).join(above, shorter == F.col("_of")).groupBy("context").agg(
        F.round(F.sum(F.col("n") * F.log(F.col("p") / F.col("_p"))), 9).alias("gain"))
    kept = gains.where(F.col("gain") >= least_gain).select("context", "gain")
    first = shares.where(F.size("context") == 1).withColumn("gain", F.lit(None).cast("double"))
    return first.unionByName(shares.join(kept, "context"))


def context_tree(df: DataFrame, depth: int = 3, least_gain: float = 10.0) -> DataFrame:
    """(context, stage, n, p, gain): shares of the next stage after every context of up to ``depth`` stages, the nearest first.

    A context of more than one stage is kept if it gains ``least_gain`` or more, in summed log likelihood, over the one without its oldest
    stage. Those of one stage are all kept, without a gain.
    """
    return _tree(_contexts(df, depth), depth, least_gain)


def context_surprise(df: DataFrame, depth: int = 3, least_gain: float = 10.0) -> DataFrame:
    """Mean of -ln p(next | longest kept context) per session. With ``depth`` 1 this is ``trajectory_surprise``."""
    moves = _contexts(df, depth)
    tree = settle(_tree(moves, depth, least_gain).select(F.struct("context", "stage").alias("_of"), (-F.log("p")).alias("_cost")))
    asked = moves.select("past", "stage").distinct()
    known = asked.select("past", "stage", F.explode(F.sequence(F.lit(1), F.size("past"))).alias("_k"))
    at = F.struct(F.slice("past", F.lit(1), F.col("_k")).alias("context"), F.col("stage"))
    cost = known.join(small_side(tree), at == F.col("_of")).groupBy("past", "stage").agg(F.max_by("_cost", "_k").alias("_cost"))
    cost = small_side(settle(cost.select(F.struct("past", "stage").alias("_at"), "_cost")))
    return moves.join(cost, F.struct("past", "stage") == F.col("_at")).groupBy(*session_key(df)).agg(
        (F.sum(F.col("_cost") * F.col("n")) / F.sum("n")).alias("surprise"), F.sum("n").alias("moves"))


def context_anomaly(df: DataFrame, depth: int = 3, least_gain: float = 10.0, max_rows: int | None = None) -> DataFrame:
    """``trajectory_anomaly`` by a context tree, which also sees what single moves do not show."""
    return _with_z(context_surprise(df, depth, least_gain), max_rows)


def trajectory_anomaly(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Surprise per session with its robust z score (0.6745 times the distance in MADs)."""
    return _with_z(trajectory_surprise(df), max_rows)


def _with_z(surprise: DataFrame, max_rows: int | None) -> DataFrame:
    # Sums of the same terms in another order may differ in the last digits.
    steady = settle(surprise.withColumn("surprise", F.round("surprise", 9)))
    middle, spread = median_and_mad(steady, "surprise", max_rows)
    z = F.lit(0.6745) * (F.col("surprise") - F.lit(middle)) / F.lit(spread or None)
    return steady.withColumn("robust_z", z)


def level_rollup(df: DataFrame, score: Column) -> DataFrame:
    """Counts and mean score by step, stage, task, session and overall."""
    rows = df.select("session_id", "task_id", "stage", "step", score.alias("_score"))
    return rows.rollup("session_id", "task_id", "stage", "step").agg(
        F.grouping_id().alias("level"), F.count("*").alias("n_rows"), F.avg("_score").alias("mean_score"))


def worst(df: DataFrame, k: int, score: str = "score", ids: list[str] | None = None,
          by: list[str] | None = None) -> DataFrame:
    """The ``k`` lowest scores, overall or per group; ties by id.

    Per group Spark drops rows past rank ``k`` before the shuffle.
    """
    ids = ids or run_key(df)
    if not by:
        return df.orderBy(score, *ids).limit(k)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(score, *ids))
    return df.withColumn("place", place).where(F.col("place") <= k)
