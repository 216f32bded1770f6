"""Mining the rules a skill's runs keep: fields, order, ranges, transitions, stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.functions.ordered import previous, run_key, running
from driftline.functions.quantile import quantiles, sketched_quantiles, value_sketches
from driftline.functions.sizing import settle
from driftline.operators.sequences import frequent_sequences
from driftline.sources import schemas


def _rules(df: DataFrame, kind: str, skill: str | None, **given: Column) -> DataFrame:
    """Mined rows in the columns of the spec table."""
    given["rule_kind"] = F.lit(kind)
    given["skill"] = F.lit(skill)
    parts = [F.coalesce(given.get(c, F.lit("")).cast("string"), F.lit("")) for c in ("before", "stage", "field")]
    given["rule_id"] = F.concat_ws(":", F.lit(kind), *parts)
    return df.select([given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in StructType.fromDDL(schemas.SPEC)])


def mine_fields(df: DataFrame, theta: float, skill: str | None = None) -> DataFrame:
    """Fields set (and not null) in at least ``theta`` of a stage's rows.

    Each row counts once under no field, which gives the stage totals in the same pass.
    """
    held = F.map_keys(F.map_filter(F.coalesce("state", F.create_map().cast("map<string,string>")),
                                   lambda _, v: v.isNotNull()))
    marks = F.array_append(held, F.lit(None).cast("string"))
    counts = df.select("stage", F.explode(marks).alias("field")).groupBy("stage", "field").count()
    total = F.max(F.when(F.col("field").isNull(), F.col("count"))).over(Window.partitionBy("stage"))
    shares = counts.withColumn("support", F.col("count") / total).where(
        F.col("field").isNotNull() & (F.col("support") >= theta))
    return _rules(shares, "required_field", skill, stage=F.col("stage"), field=F.col("field"),
                  support=F.col("support"))


def visit_orders(df: DataFrame) -> DataFrame:
    """The different orders in which runs first reach their stages, with how many runs take each.

    A run's order has one entry per stage, so it stays short however long the run is; a run without any stage has
    an empty one and counts as a run.
    """
    key = run_key(df)
    firsts = df.groupBy(*key, "stage").agg(F.min("step").alias("at"))
    reached = F.when(F.col("stage").isNotNull(), F.struct("at", "stage"))
    paths = firsts.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(reached)), lambda r: r["stage"]).alias("path"))
    return paths.groupBy("path").agg(F.count("*").alias("n"))


def order_shares(orders: DataFrame) -> DataFrame:
    """For each pair of stages: runs holding both, and the share reaching ``before`` first.

    Pairs are formed per different order, not per run.
    """
    first = orders.select("n", "path", F.posexplode("path").alias("i", "a"))
    pairs = first.select("n", "i", "a", F.posexplode("path").alias("j", "b")).where("i <> j")
    held = pairs.groupBy("a", "b").agg(
        F.sum("n").alias("both"), F.sum(F.when(F.col("i") < F.col("j"), F.col("n")).otherwise(0)).alias("kept"))
    return held.select(F.col("a").alias("before"), F.col("b").alias("stage"), "both",
                       (F.col("kept") / F.col("both")).alias("support"))


def stage_shares(orders: DataFrame) -> DataFrame:
    """Share of runs reaching each stage; every order counts once under no stage, which gives the total."""
    marks = F.array_append("path", F.lit(None).cast("string"))
    counts = orders.select("n", F.explode(marks).alias("stage")).groupBy("stage").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("stage").isNull(), F.col("n"))).over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("support", F.col("n") / total).where("stage is not null")


def _order_rules(orders: DataFrame, theta: float, skill: str | None) -> DataFrame:
    kept = order_shares(orders).where(F.col("support") >= theta)
    return _rules(kept, "precedence", skill, before=F.col("before"), stage=F.col("stage"), support=F.col("support"))


def _stage_rules(orders: DataFrame, theta: float, skill: str | None) -> DataFrame:
    kept = stage_shares(orders).where(F.col("support") >= theta)
    return _rules(kept, "mandatory_stage", skill, stage=F.col("stage"), support=F.col("support"))


def mine_order(df: DataFrame, theta: float, skill: str | None = None) -> DataFrame:
    """Stage pairs reached in one order by at least ``theta`` of the runs holding both."""
    return _order_rules(visit_orders(df), theta, skill)


def mine_stages(df: DataFrame, theta: float, skill: str | None = None) -> DataFrame:
    """Stages reached in at least ``theta`` of the runs."""
    return _stage_rules(visit_orders(df), theta, skill)


def mine_ranges(df: DataFrame, lo: float, hi: float, skill: str | None = None,
                max_rows: int | None = None) -> DataFrame:
    """The range between two exact quantiles of ``value`` per stage."""
    bounds = quantiles(df, ["stage"], "value", {"lo": lo, "hi": hi}, max_rows)
    return _rules(bounds, "range", skill, stage=F.col("stage"), lo=F.col("lo"), hi=F.col("hi"), support=F.lit(hi - lo))


def transition_shares(df: DataFrame) -> DataFrame:
    """Stage to stage counts within sessions and the share of each among its source's exits."""
    moves = running(df, {"before": previous("stage")}, key=run_key(df)).where("before is not null")
    counts = moves.groupBy("before", "stage").agg(F.count("*").alias("n"))
    return counts.withColumn("support", F.col("n") / F.sum("n").over(Window.partitionBy("before")))


def range_sketches(df: DataFrame) -> DataFrame:
    """What is kept of a version's values per stage, so that ranges over any span of versions need no second look at earlier ones; see ``value_sketches``."""
    return value_sketches(df, ["version", "stage"], "value")


def mine_ranges_over(sketches: DataFrame, df: DataFrame, lo: float, hi: float, skill: str | None = None) -> DataFrame:
    """``mine_ranges`` of the rows ``df`` of a span of versions, bracketed by the sketches kept of these versions."""
    found = sketched_quantiles(sketches, df, ["stage"], "value", {"lo": lo, "hi": hi})
    return _rules(found, "range", skill, stage=F.col("stage"), lo=F.col("lo"), hi=F.col("hi"))


def mine_transitions(df: DataFrame, theta: float, skill: str | None = None) -> DataFrame:
    """Transitions taken in at least ``theta`` of the exits of their source stage."""
    kept = transition_shares(df).where(F.col("support") >= theta)
    return _rules(kept, "transition", skill, before=F.col("before"), stage=F.col("stage"), support=F.col("support"))


def mine_sequences(df: DataFrame, theta: float, longest: int = 3, skill: str | None = None) -> DataFrame:
    """Sequences of stages, in this order with anything between, that at least ``theta`` of the runs hold; those inside a longer one are left out.

    ``before`` has all stages but the last, joined by ``>``, which no stage's name may hold.
    """
    found = [(">".join(q[:-1]) or None, q[-1], share) for q, share in frequent_sequences(df, theta, longest) if len(q) > 1]
    rows = df.sparkSession.createDataFrame(found, "before string, stage string, support double")
    return _rules(rows, "sequence", skill, before=F.col("before"), stage=F.col("stage"), support=F.col("support"))


def extract_spec(df: DataFrame, theta: float, lo: float = 0.05, hi: float = 0.95,
                 skill: str | None = None) -> DataFrame:
    """All mined rules of a skill in one spec table."""
    orders = settle(visit_orders(df))
    return (mine_fields(df, theta, skill)
            .unionByName(_order_rules(orders, theta, skill))
            .unionByName(mine_ranges(df, lo, hi, skill))
            .unionByName(mine_transitions(df, theta, skill))
            .unionByName(_stage_rules(orders, theta, skill)))
