"""Distance between the expected workflow and the path a run took."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import lookup
from driftline.functions.ordered import run_key

# Codes of this many steps go into one part.
LIST_STEPS = 100_000


def path_distance(df: DataFrame, expected: list[str], list_steps: int | None = None) -> DataFrame:
    """Edits between the expected and the actual stage sequence, and fitness 1 - d / longest.

    Stages outside the workflow can match nothing and share one code. A run is read in parts
    of at most ``list_steps`` steps. A run of one part is compared directly; a part of a
    longer one gives, for all places i <= j of the workflow, the edits that turn
    workflow[i:j] into it, and those tables chain by their least sums.
    """
    size = list_steps or LIST_STEPS
    key = run_key(df)
    n = len(expected)
    codes = {stage: chr(0x4E00 + i) for i, stage in enumerate(sorted(set(expected)))}
    target = "".join(codes[s] for s in expected)
    coded = df.select(*key, "step", F.floor((F.col("step") - 1) / size).alias("_part"),
                      F.coalesce(lookup(codes)[F.col("stage")], F.lit("?")).alias("_code"))
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "_code"))), lambda r: r["_code"]), "")
    parts = coded.groupBy(*key, "_part").agg(F.count("*").alias("_n"), F.max("step").alias("_last"), path.alias("_path"))

    # Part 0 ending before its limit is the whole run.
    whole = (F.col("_part") == 0) & (F.col("_last") < size)
    table = F.array(*[F.array(*[F.levenshtein("_path", F.lit(target[i:j])) for j in range(i, n + 1)]) for i in range(n + 1)])
    measured = parts.withColumns({
        "_direct": F.when(whole, F.levenshtein("_path", F.lit(target))), "_table": F.when(~whole, table)})
    runs = measured.groupBy(*key).agg(
        F.sum("_n").alias("n_rows"), F.max("_direct").alias("_direct"),
        F.array_sort(F.collect_list(F.struct("_part", F.col("_table").alias("t")))).alias("_tables"))
    start = F.array(*[F.lit(0 if i == 0 else 2**40).cast("bigint") for i in range(n + 1)])

    def chain(costs, part):
        return F.array(*[F.array_min(F.array(*[costs[i] + part["t"][i][j - i] for i in range(j + 1)])) for j in range(n + 1)])

    chained = F.aggregate("_tables", start, chain)[n]
    distance = F.coalesce(F.col("_direct").cast("bigint"), chained)
    return runs.withColumn("distance", distance).select(
        *key, "n_rows", "distance", (1 - F.col("distance") / F.greatest(F.col("n_rows"), F.lit(n))).alias("fitness"))
