"""Preference formatting: the shared beginning of a chosen and a rejected conversation becomes one prompt.

Turns are compared place by place; the longest common prefix is rendered once, the rest of either side is its completion. A
completion comes with the stretches of its text to learn from: what the assistant says, with the mark that ends the turn.
DataFrame functions only; a conversation is put together in one row because the rendered text is one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions.sizing import store
from driftline.llm.registry import query, table

OPEN, CLOSE, END = "<|", "|>\n", "\n<|end|>\n"
LEARNT_ROLE = "assistant"


def rendered(turns):
    """Text of an array of (role, text) structs."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def mask(turns):
    """``start-end`` pairs, comma-joined, of what the assistant says and its end mark, in characters of ``rendered``."""
    def step(state, t):
        head = F.length(F.lit(OPEN)) + F.length(t["role"]) + F.length(F.lit(CLOSE))
        body = F.length(t["text"]) + F.length(F.lit(END))
        span = F.concat_ws("-", (state["at"] + head).cast("string"), (state["at"] + head + body).cast("string"))
        return F.struct((state["at"] + head + body).cast("long").alias("at"),
                        F.when(t["role"] == LEARNT_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) from rows (conv_id, turn, role, text), in order of turn, then role and text; null role and text are empty.

    Rows without conv_id or turn belong to no conversation and are left out; equal rows are one turn.
    """
    empty = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = empty.groupBy("conv_id").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Rows (pair_id, chosen, rejected), arrays of (role, text), as prompts and masked completions.

    Gives pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask and rejected_mask; masks are character ranges of the completion. Other columns are
    left out. A null array is an empty conversation; equal conversations have empty completions, and a conversation that is the
    beginning of the other has one. Null parts of a turn are empty. Repeated pairs stay repeated.
    """
    whole = [F.transform(F.coalesce(c, F.array().cast("array<struct<role:string,text:string>>")), lambda t: F.struct(
        F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))) for c in ("chosen", "rejected")]
    df = pairs.select("pair_id", whole[0].alias("c"), whole[1].alias("r"))
    shortest = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", 1, shortest), F.slice("r", 1, shortest), lambda a, b: a == b)
    differs = F.array_position(same, False)
    df = df.withColumn("prompt_turns", F.when(differs > 0, differs - 1).otherwise(shortest).cast("long"))
    n = F.col("prompt_turns").cast("int")
    df = df.withColumn("p", F.slice("c", F.lit(1), n))
    for c in ("c", "r"):
        df = df.withColumn(c, F.slice(c, n + 1, F.size(c)))
    return df.select("pair_id", "prompt_turns", rendered(F.col("p")).alias("prompt"), rendered(F.col("c")).alias("chosen"), rendered(F.col("r")).alias("rejected"),
                     mask(F.col("c")).alias("chosen_mask"), mask(F.col("r")).alias("rejected_mask"))


def numbered(df: DataFrame, by: str) -> DataFrame:
    """``df`` with ``n``, its place from 0 by the unique column ``by``: counted in range-sorted partitions, not in one."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = store(df.repartitionByRange(parts, by).withColumn("part", F.spark_partition_id()))
    # One row per partition says how many rows stand before it.
    before = dealt.groupBy("part").agg(F.count("*").alias("held")).withColumn(
        "before", F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("part").orderBy(by)) - 1
    return dealt.withColumn("k", within).join(before, "part").withColumn("n", F.col("before") + F.col("k")).drop("part", "held", "before", "k")


def mismatched_answers(convs: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) for conversations with an answer: the last one against another conversation's last.

    Chosen is the conversation up to its last assistant turn; rejected has there the last assistant turn of the next such conversation by
    conv_id, the first one's for the last. With one conversation only, the pair is equal.
    """
    at = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == LEARNT_ROLE), True).cast("int") + 1
    answered = convs.withColumn("at", at).where(F.exists("turns", lambda t: t["role"] == LEARNT_ROLE))
    answered = numbered(answered.select("conv_id", F.slice("turns", F.lit(1), F.col("at")).alias("chosen")), "conv_id")
    total = answered.agg(F.count("*").alias("n")).first()["n"]
    if not total:
        return answered.select(F.col("conv_id").alias("pair_id"), "chosen", F.col("chosen").alias("rejected"))
    donors = answered.select(F.pmod(F.col("n") - 1, F.lit(total)).alias("n"), F.element_at("chosen", -1).alias("other"))
    return answered.join(donors, "n").select(F.col("conv_id").alias("pair_id"), "chosen", F.concat(
        F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array("other")).alias("rejected"))


def turn_sql(array: str) -> str:
    return f"array_to_string(list_transform({array}, lambda x: '<|' || x.role || '|>\n' || x.text || '\n<|end|>\n'), '')"


def mask_sql(array: str) -> str:
    size = "length('<|' || x.role || '|>\n' || x.text || '\n<|end|>\n')"
    before = f"coalesce(list_sum(list_transform({array}[1:i - 1], lambda x: {size})), 0)"
    return (f"coalesce((SELECT string_agg(concat(CAST({before} + length({array}[i].role) + 5 AS BIGINT), '-', CAST({before} + length({array}[i].role) + 5 + length({array}[i].text) + 9 AS BIGINT)), ',' ORDER BY i)"
            f" FROM range(1, len({array}) + 1) g(i) WHERE {array}[i].role = 'assistant'), '')")


@query(f"""WITH c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn) AS turns, list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id),
a AS (SELECT conv_id, turns[1:len(turns) - list_position(list_reverse(roles), 'assistant') + 1] AS chosen FROM c WHERE list_contains(roles, 'assistant')),
n AS (SELECT *, coalesce(lead(chosen[-1]) OVER (ORDER BY conv_id), first_value(chosen[-1]) OVER (ORDER BY conv_id)) AS other FROM a),
p AS (SELECT conv_id, chosen, list_append(chosen[1:len(chosen) - 1], other) AS rejected, CASE WHEN chosen[-1] = other THEN len(chosen) ELSE len(chosen) - 1 END AS k FROM n),
s AS (SELECT conv_id, k, chosen[1:k] AS prompt, chosen[k + 1:] AS c, rejected[k + 1:] AS r FROM p)
SELECT conv_id AS pair_id, CAST(k AS BIGINT) AS prompt_turns, {turn_sql('s.prompt')} AS prompt, {turn_sql('s.c')} AS chosen, {turn_sql('s.r')} AS rejected,
       {mask_sql('s.c')} AS chosen_mask, {mask_sql('s.r')} AS rejected_mask FROM s""")
def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return format_pairs(mismatched_answers(conversations(turns)))
