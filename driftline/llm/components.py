"""Connected components of links, by alternating large and small stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.sizing import store


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); the component is the smallest id reachable.

    Each round links every id to the smallest neighbour seen so far; rounds grow with the logarithm of the longest path. Minima are
    aggregated within tasks before they move, and joins on an id with many links can be split. Null and self links say nothing
    but that their id exists. State between rounds is written to the shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    every = links = store(links.distinct())
    links = links.where("a <> b")
    seen = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        stars = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # The smallest id of a neighbourhood is linked to its neighbours by the lines of the larger ones.
        stars = stars.where("a <> b").distinct()
        down = stars.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = stars.join(down, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = store(small.union(down.select("u", "m")).where("a <> b").distinct())
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if now == seen:
            break
        seen = now
    ids = every.select(F.col("a").alias("id")).union(every.select("b")).distinct()
    return ids.join(links.withColumnRenamed("a", "id"), "id", "left").select("id", F.coalesce("b", "id").alias("component"))
