"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, exact cuts.

Documents of a source are ordered by a random key made from a hash. A source's budget is met by whole epochs and a
last partial one, cut where the running sum of sizes reaches the rest. The range sort deals one source over many
partitions, so a source that holds most rows is no single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions.sizing import settle, small_side, store
from driftline.llm.registry import query, shielded, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
SEED = "mix-1"


def count_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row each.

    Sources by code point, null last, take ``weights`` in turn. The budget is ``share_percent`` of all sizes; what a source
    would get beyond ``most_epochs`` times its size goes to the others by weight. Closed form: in order of size over
    weight, a source is full if giving it and all later ones its level would exceed the budget. The
    window is over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).cast("double")
    out = sizes.withColumn("weight", weight).withColumn("most", (most_epochs * F.col("source_size")).cast("double"))
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share_percent)) / F.lit(100.0)
    out = (out.withColumn("budget", budget)
           .withColumn("given", F.coalesce(F.sum("most").over(before), F.lit(0.0))).withColumn("sharing", F.sum("weight").over(onward))
           .withColumn("full", F.col("most") * F.col("sharing") <= (F.col("budget") - F.col("given")) * F.col("weight")))
    # Those that are not full share what the full ones leave.
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(Window.partitionBy()), F.lit(0.0))
    shared = F.sum(F.when(~F.col("full"), F.col("weight"))).over(Window.partitionBy())
    return out.select("source", "source_size", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * rest / shared).alias("target"))


def random_key(doc_id, seed: str):
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))


def portion(sized: DataFrame, seed: str = SEED) -> DataFrame:
    """Rows of (doc_id, source, size) with ``key``, ``source_size``, ``target``, whole ``epochs`` and ``last``.

    ``last`` is how many words of the row the partial epoch takes. The sorted rows are written once, since the number of
    the partition that holds a row must stay the same for both uses.
    """
    spark = sized.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size")]
    keyed = sized.select("doc_id", "source", "size", random_key(F.col("doc_id"), seed).alias("key"))
    keyed = store(keyed.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))

    # One row for each source in each partition: what earlier partitions hold is added to the sums within.
    pieces = keyed.groupBy("source", "part").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before_part", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    goals = targets(pieces.groupBy("source").agg(F.sum("held").cast("long").alias("source_size"))).withColumnRenamed("source", "s")
    pieces = pieces.join(goals, F.col("source").eqNullSafe(F.col("s"))).select(
        "s", F.col("part").alias("p"), "before_part", "source_size", "target")

    within = Window.partitionBy("part", "source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(pieces, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).drop("s", "p", "part")
    wanted = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = wanted - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before_part") - F.col("before")))
    return rows.select("doc_id", "source", "size", "key", "source_size", "target", epochs.alias("epochs"), last.alias("last"))


def draw(sized: DataFrame, seed: str = SEED) -> DataFrame:
    """How many words of each row of (doc_id, source, size) the mix takes: ``taken``, beside ``source_size`` and ``target``.

    A document is taken as often as the source's whole epochs say, and once more, whole or up to the cut, in the last one. The
    sum over a source is its target rounded down. Null sources form one source, null ids sort first, rows without
    words take nothing; of equal rows either may hold the cut. An empty table gives an empty one; other columns are dropped.
    """
    taken = F.col("epochs") * F.col("size") + F.col("last")
    return portion(sized, seed).select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed documents: rows of ``docs`` with all columns, each repeated as often as the mix takes it.

    Texts stay whole: the document at the cut is taken if at least half of it lies before the cut, so a source is off its
    budget by half a document at most. Rows with one id stand or fall together at the cut. Texts are not shuffled:
    a source's cut is a place in the key order, so one row per source tells each document its number of copies. Texts without
    words cost nothing and are copied like others of their place.
    """
    sizes = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))
    after = F.when(2 * F.col("last") < F.col("size"), F.struct("key", "doc_id"))
    cuts = portion(sizes, seed).groupBy("source").agg(F.max("epochs").alias("_epochs"), F.min(after).alias("_cut"))
    cuts = small_side(settle(cuts.withColumnRenamed("source", "_source")))
    place = F.struct(random_key(F.col("doc_id"), seed).alias("key"), F.col("doc_id"))
    more = F.when(F.col("_cut").isNull() | (place < F.col("_cut")), 1).otherwise(0)
    copies = F.sequence(F.lit(1), (F.col("_epochs") + more).cast("int"))
    rows = shielded(docs, "doc_id", "source")
    taken = rows.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).where(F.col("_epochs") + more > 0)
    return taken.withColumn("_copy", F.explode(copies)).select(*rows.columns).toDF(*docs.columns)


@query(rf"""WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
             CAST(2 * source_size AS DOUBLE) AS most, CAST(sum(source_size) OVER () AS DOUBLE) * 150.0::DOUBLE / 100.0::DOUBLE AS budget FROM s),
f AS (SELECT *, most * sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS filled
      FROM w),
t AS (SELECT source, source_size, CASE WHEN filled THEN most ELSE
             weight * (budget - coalesce(sum(CASE WHEN filled THEN most END) OVER (), 0)) / sum(CASE WHEN NOT filled THEN weight END) OVER () END AS target FROM f),
o AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id, size
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // source_size * size
            + greatest(0, least(size, CAST(floor(target) AS BIGINT) % source_size - before)) END AS BIGINT) AS taken
FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return draw(docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))).select(
        "doc_id", "size", "source_size", "target", "taken")
