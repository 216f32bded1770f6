"""Exact quantiles that never hold one group's values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.ordered import running, running_sum, segment
from driftline.functions.sizing import settle, small_side

MAX_GROUP_VALUES = 1_000_000
ACCURACY = 10_000


def quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float],
              max_rows: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group, one column per entry of ``probs``.

    Groups of few rows use the built-in ``percentile`` over counted values. Large ones take
    sketches to bracket each wanted rank, count what lies below the bracket, and rank only the
    few values inside it. Should a sketch have missed, the bracket is widened to everything.
    Both ways interpolate by the same formula; a null group key is a group like any other.
    """
    max_rows = max_rows or MAX_GROUP_VALUES
    v = F.col(value).cast("double")
    # One struct holds the key: its fields may be null, and joins on it still meet.
    key = F.struct(*by) if by else F.struct(F.lit(1).alias("all"))
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(key.alias("_g"), v.alias("_v"))
    named = [F.col("_g")[c].alias(c) for c in by]
    sizes = rows.groupBy("_g").agg(F.count("*").alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= max_rows:
        counted = rows.groupBy("_g", "_v").agg(F.count("*").alias("_w"))
        wanted = F.percentile("_v", F.array(*map(F.lit, probs.values())), F.col("_w"))
        out = counted.groupBy("_g").agg(wanted.alias("_q"))
        return out.select(*named, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])

    brackets = [rows.groupBy("_g").agg(F.count("*").alias("_n"), F.array(*[_bracket(i, p, sketched) for i, p in enumerate(probs.values())]).alias("_b"))
                for sketched in (True, False)]
    return _exact(rows, brackets, probs, max_rows).select(*named, *probs)


def _exact(rows: DataFrame, brackets: list[DataFrame], probs: dict[str, float], max_rows: int) -> DataFrame:
    """Quantiles per group ``_g`` by the first of the ``brackets``; by the second, should a value lie outside the first."""
    near = settle(brackets[0])
    picks = settle(_picks(rows, near, max_rows))
    hit = picks.where(F.col("_low").isNotNull() & F.col("_high").isNotNull())
    if hit.count() < near.count() * len(probs):
        picks = settle(_picks(rows, settle(brackets[1]), max_rows))
    # As the built-in percentile does it.
    place = F.col("_p") * (F.col("_n") - 1)
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        (F.ceil(place) - place) * F.col("_low") + (place - F.floor(place)) * F.col("_high"))
    values = [F.max(F.when(F.col("_i") == i, between)).alias(n) for i, n in enumerate(probs)]
    return picks.groupBy("_g").agg(*values)


def _picks(rows: DataFrame, brackets: DataFrame, max_rows: int) -> DataFrame:
    """Per group and probability the values at the two ranks around it, null where the bracket misses."""
    marked = rows.join(small_side(brackets), "_g")
    below = marked.select("_g", "_v", F.inline("_b")).groupBy("_g", "_i").agg(
        F.count_if(F.col("_v") < F.col("_from")).alias("_below"))
    inside = marked.select("_g", "_v", F.inline(F.filter(
        "_b", lambda b: (F.col("_v") >= b["_from"]) & (F.col("_v") <= b["_to"]))))
    counted = settle(inside.groupBy("_g", "_i", "_v").agg(F.count("*").alias("_w")))
    ranked = running(segment(counted, ["_g", "_i"], ["_v"], max_rows), {"_upto": running_sum("_w")},
                     key=["_g", "_i"], order=["_v"])
    wanted = brackets.select("_g", "_n", F.inline("_b")).join(below, ["_g", "_i"])
    found = ranked.join(small_side(settle(wanted)), ["_g", "_i"])
    place = F.col("_p") * (F.col("_n") - 1)

    def at(rank: Column) -> Column:
        upto = F.col("_below") + F.col("_upto")
        return F.max(F.when((upto - F.col("_w") <= rank) & (rank < upto), F.col("_v")))

    return found.groupBy("_g", "_i", "_p", "_n").agg(
        at(F.floor(place)).alias("_low"), at(F.ceil(place)).alias("_high"))


def _bracket(i: int, p: float, sketched: bool) -> Column:
    """Values sure to lie on either side of the ranks around ``p``, by sketch or at the ends."""
    slack = 4 / ACCURACY
    low = F.percentile_approx("_v", p - slack, ACCURACY) if sketched and p > slack else F.min("_v")
    high = F.percentile_approx("_v", p + slack, ACCURACY) if sketched and p < 1 - slack else F.max("_v")
    return F.struct(F.lit(i).alias("_i"), F.lit(p).alias("_p"), low.alias("_from"), high.alias("_to"))


SKETCH_K = 1_000            # of the stored sketches
SKETCH_SLACK = 0.01         # three times the rank error that they have with odds 0.99


def value_sketches(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, n, least, most, sketch): what is kept of the values of each group, a few kilobytes however many they are.

    Sketches of groups can be put together, so those of a version's stages serve every span of versions. Null values and NaN do not count; a group of none has no row.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).withColumn("_v", v)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"), F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, df: DataFrame, by: list[str], value: str, probs: dict[str, float], max_rows: int | None = None) -> DataFrame:
    """``quantiles`` of ``df`` per group of ``by`` from stored ``sketches`` of finer groups of the same rows.

    The sketches are put together and bracket each rank; one pass over ``df`` then counts what lies below the brackets and ranks what lies inside.
    Should a sketch have missed, the bracket is widened to everything.
    """
    key = F.struct(*by) if by else F.struct(F.lit(1).alias("all"))
    whole = settle(sketches.groupBy(key.alias("_g")).agg(F.sum("n").alias("_n"), F.min("least").alias("_least"), F.max("most").alias("_most"),
                                                         F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("_sketch")))

    def bracket(i: int, p: float, sketched: bool) -> Column:
        low = F.kll_sketch_get_quantile_double("_sketch", F.lit(min(1.0, p - SKETCH_SLACK))) if sketched and p > SKETCH_SLACK else F.col("_least")
        high = F.kll_sketch_get_quantile_double("_sketch", F.lit(max(0.0, p + SKETCH_SLACK))) if sketched and p < 1 - SKETCH_SLACK else F.col("_most")
        return F.struct(F.lit(i).alias("_i"), F.lit(p).alias("_p"), low.alias("_from"), high.alias("_to"))

    brackets = [whole.select("_g", "_n", F.array(*[bracket(i, p, sketched) for i, p in enumerate(probs.values())]).alias("_b")) for sketched in (True, False)]
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(key.alias("_g"), v.alias("_v"))
    return _exact(rows, brackets, probs, max_rows or MAX_GROUP_VALUES).select(*[F.col("_g")[c].alias(c) for c in by], *probs)


def median_and_mad(df: DataFrame, value: str, max_rows: int | None = None) -> tuple[float | None, float | None]:
    """Median and median absolute deviation of one column, as two driver-side numbers."""
    middle = quantiles(df, [], value, {"m": 0.5}, max_rows).first()
    if middle is None or middle["m"] is None:
        return None, None
    off = df.select(F.abs(F.col(value) - F.lit(middle["m"])).alias("_d"))
    return middle["m"], quantiles(off, [], "_d", {"m": 0.5}, max_rows).first()["m"]
