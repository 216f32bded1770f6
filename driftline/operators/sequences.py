"""Ordered sequences of stages that most runs hold, and runs that lack them.

A run holds a sequence if its stages come in that order, with anything between. Frequent sequences are grown prefix by prefix: only what most runs
hold is made longer, by stages that most runs hold. A run's stages are one string of codes, written once for all rounds; whether a sequence is in it is
told by looking for its stages one after the other, each after the one before.

A string longer than ``PART_STEPS`` is cut. Of each part it is then told, for every number of stages that may be found before it, how many are found
after it; these small tables chain along the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import lookup
from driftline.functions.ordered import run_key
from driftline.functions.sizing import settle, small_side, store

PART_STEPS = 100_000
AT_ONCE = 200               # sequences looked for in one pass
FIRST_CODE = 0x4E00


def coded_runs(df: DataFrame, part_steps: int | None = None) -> tuple[DataFrame, dict[str, str]]:
    """(keys, part, path, whole) with one letter per step, and the letter of each stage that rows name.

    Stages are few: their list reaches the driver. Steps without a stage or a number are left out of the path; a run of such steps only has an empty one.
    """
    size = part_steps or PART_STEPS
    key = run_key(df)
    stages = sorted(r[0] for r in df.select("stage").where("stage IS NOT NULL").distinct().collect())
    codes = {s: chr(FIRST_CODE + k) for k, s in enumerate(stages)}
    code = lookup(codes)[F.col("stage")] if codes else F.lit(None).cast("string")
    rows = df.select(*key, "step", code.alias("_code"), F.coalesce(F.floor((F.col("step") - 1) / size), F.lit(0)).alias("part"))
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_code").isNotNull() & F.col("step").isNotNull(), F.struct("step", "_code")))), lambda r: r["_code"]), "")
    parts = store(rows.groupBy(*key, "part").agg(path.alias("path")))
    many = small_side(settle(parts.groupBy(*key).count().where("count > 1").select(F.struct(*key).alias("_long"))))
    marked = parts.join(many, F.struct(*key) == F.col("_long"), "left").withColumn("whole", F.col("_long").isNull()).drop("_long")
    return store(marked), codes


def _found(path: str, sequence: str, start: int = 0) -> Column:
    """How many stages of ``sequence`` are found if ``start`` of them were found before ``path``."""
    places: list[str] = []
    for letter in sequence[start:]:
        places.append(f"locate('{letter}', {path}, {f'({places[-1]}) + 1' if places else 1})")
    out = F.lit(len(sequence))
    for k in range(len(places) - 1, -1, -1):
        out = F.when(F.expr(places[k]) == 0, F.lit(start + k)).otherwise(out)
    return out


def _holds(runs: DataFrame, sequences: list[str]) -> DataFrame:
    """(keys, held): for each run which of the ``sequences`` it holds."""
    key = run_key(runs)
    whole = runs.where("whole").select(*key, F.array(*[_found("path", s) == len(s) for s in sequences]).alias("held"))
    table = F.array(*[F.array(*[_found("path", s, k) for k in range(len(s))], F.lit(len(s))) for s in sequences])
    cut = runs.where("NOT whole").select(*key, "part", table.alias("t")).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("part", "t"))).alias("_all"))
    ends = F.aggregate("_all", F.array(*[F.lit(0)] * len(sequences)), lambda now, r: F.transform(now, lambda n, i: r["t"][i][n]))
    done = F.array(*[F.lit(len(s)) for s in sequences])
    return whole.unionByName(cut.select(*key, F.zip_with(ends, done, lambda a, b: a == b).alias("held")))


def _supports(runs: DataFrame, sequences: list[str]) -> list[int]:
    """In how many runs each of the ``sequences`` is."""
    counts: list[int] = []
    for at in range(0, len(sequences), AT_ONCE):
        some = sequences[at:at + AT_ONCE]
        row = _holds(runs, some).agg(*[F.count_if(F.col("held")[i]).alias(f"n{i}") for i in range(len(some))]).first()
        counts += [int(n) for n in row]
    return counts


def frequent_sequences(df: DataFrame, theta: float, longest: int = 3, part_steps: int | None = None) -> list[tuple[tuple[str, ...], float]]:
    """Sequences of up to ``longest`` stages that at least the share ``theta`` of all runs hold, and that are part of no longer one found; with their shares."""
    runs, codes = coded_runs(df, part_steps)
    names = {c: s for s, c in codes.items()}
    total = runs.select(*run_key(runs)).distinct().count()
    found: dict[str, float] = {}
    singles: list[str] = []
    grown = list(codes.values())
    for _ in range(longest):
        if not grown or not total:
            break
        kept = {s: n / total for s, n in zip(grown, _supports(runs, grown)) if n / total >= theta}
        found |= kept
        singles = singles or list(kept)
        grown = [s + c for s in kept for c in singles]
        # Whatever is frequent has only frequent parts.
        grown = [s for s in grown if all(s[:k] + s[k + 1:] in found for k in range(len(s)))]
    inside = lambda a, b: len(a) < len(b) and all(c in it for it in [iter(b)] for c in a)
    return sorted((tuple(names[c] for c in s), share) for s, share in found.items() if not any(inside(s, t) for t in found))


def lacking(df: DataFrame, sequences: list[tuple[str, ...]], part_steps: int | None = None) -> DataFrame:
    """(keys, sequence) for every run and every one of the ``sequences`` it does not hold."""
    runs, codes = coded_runs(df, part_steps)
    key = run_key(runs)
    if not sequences:
        return runs.limit(0).select(*key, F.lit("").alias("sequence"))
    # A stage that no row names is no letter of any path.
    spelt = ["".join(codes.get(s, chr(FIRST_CODE - 1)) for s in q) for q in sequences]
    names = F.array(*[F.lit(">".join(q)) for q in sequences])
    missed = F.filter(F.arrays_zip(names.alias("name"), F.col("held")), lambda x: ~x["held"])
    return _holds(runs, spelt).select(*key, F.explode(F.transform(missed, lambda x: x["name"])).alias("sequence"))
