"""What several verifiers together say, each weighed by how it errs.

Truth and error rates are estimated in turns: from what each finding probably is follow each verifier's rates (which verdict it gives how often to what is
really this or that), from the rates follows again what each finding probably is. Findings with equal ballots are one row throughout, and a
round's result is the table of rates, a few rows per verifier, so nothing else is carried from round to round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.sizing import settle, small_side, store

VERDICTS = ("confirm", "correct", "insufficient")
ROUNDS = 5


def ballots_of(verdicts: DataFrame) -> DataFrame:
    """(finding_id, ballot): the different votes on a finding, a verifier's repeated vote once."""
    known = verdicts.where(F.col("verdict").isin(*VERDICTS) & F.col("finding_id").isNotNull() & F.col("reviewer").isNotNull())
    return known.groupBy("finding_id").agg(F.array_sort(F.collect_set(F.struct("reviewer", "verdict"))).alias("ballot"))


def _rates(shares: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (ballot, n, share of each truth): logarithms of the rates per (reviewer, verdict), and one row of those of the truths. Each count starts at one."""
    parts = [F.col("share")[c] * F.col("n") for c in range(len(VERDICTS))]
    given = shares.select("n", "share", F.inline("ballot")).groupBy("reviewer", "verdict").agg(*[F.sum(p).alias(f"s{c}") for c, p in enumerate(parts)])
    total = given.groupBy(F.col("reviewer").alias("_r")).agg(*[F.sum(f"s{c}").alias(f"t{c}") for c in range(len(VERDICTS))])
    rates = given.join(small_side(settle(total)), F.col("reviewer") == F.col("_r")).select(
        "reviewer", "verdict", F.array(*[F.log((F.col(f"s{c}") + 1) / (F.col(f"t{c}") + len(VERDICTS))) for c in range(len(VERDICTS))]).alias("rate"))
    truths = shares.agg(*[F.sum(p).alias(f"s{c}") for c, p in enumerate(parts)], F.sum("n").alias("n"))
    truths = truths.select(F.array(*[F.log((F.coalesce(f"s{c}", F.lit(0.0)) + 1) / (F.coalesce("n", F.lit(0)) + len(VERDICTS))) for c in range(len(VERDICTS))]).alias("prior"))
    return settle(rates), settle(truths)


def _shares(patterns: DataFrame, rates: DataFrame, truths: DataFrame) -> DataFrame:
    """(ballot, n, share): how probable each truth is for a ballot."""
    votes = patterns.select("ballot", "n", F.inline("ballot")).join(small_side(rates), ["reviewer", "verdict"])
    sums = votes.groupBy("ballot", "n").agg(*[F.sum(F.col("rate")[c]).alias(f"l{c}") for c in range(len(VERDICTS))])
    sums = sums.join(F.broadcast(truths)).withColumn("all", F.array(*[F.col(f"l{c}") + F.col("prior")[c] for c in range(len(VERDICTS))]))   # one row
    shifted = F.transform("all", lambda x: F.exp(x - F.array_max("all")))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return sums.select("ballot", "n", F.transform(shifted, lambda x: x / total).alias("share"))


def _said(verdict: str):
    return F.size(F.filter("ballot", lambda b: b["verdict"] == verdict))


def weighed_votes(verdicts: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Per finding its most probable verdict, and per verifier how often it gives which verdict to what.

    ``verdicts`` have finding_id, reviewer and verdict; rows without one of them, or of another verdict, say nothing. The first guess is each ballot's
    shares of votes. The first table has finding_id, n_votes, decision and probability, ties going to the verdict named first in
    ``VERDICTS``; the second reviewer, truth, verdict and rate.
    """
    ballots = store(ballots_of(verdicts))
    patterns = store(ballots.groupBy("ballot").agg(F.count("*").alias("n")))
    first = F.array(*[_said(v) / F.size("ballot") for v in VERDICTS])
    shares = patterns.withColumn("share", first)
    for _ in range(rounds):
        rates, truths = _rates(shares)
        shares = _shares(patterns, rates, truths)
    best = F.array_max("share")
    decided = store(shares.select("ballot", F.element_at(F.array(*map(F.lit, VERDICTS)), F.array_position("share", best).cast("int")).alias("decision"), best.alias("probability")))
    found = ballots.join(small_side(decided), "ballot").select("finding_id", F.size("ballot").alias("n_votes"), "decision", "probability")
    truth = F.explode(F.map_from_arrays(F.array(*map(F.lit, VERDICTS)), F.transform("rate", lambda x: F.exp(x))))
    return found, rates.select("reviewer", "verdict", truth.alias("truth", "rate"))
