"""Which steps of a run a workflow accounts for: alignment with a graph of stages that may branch and loop.

A run is laid along a way through the graph so that as little as possible is amiss: a step may stand for a stage (matched), stand in for another one
(replaced) or be left over (inserted), and stages on the way may have no step (skipped); each of the last three costs one. Of equally
cheap ways the one with fewest replaced, then fewest skipped stages is taken, then a step is rather matched than inserted, and comes from the earlier
listed stage. The cost on a graph without branches is the edit distance of ``path_distance``.

Runs of up to ``PART_STEPS`` steps are aligned whole. Longer ones are cut: each part gives the costs between all pairs of stages, these tables chain by
least sums, parts then tell for each stage they may end at where they began, and last, with its end known, each part tells its moves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.ordered import run_key
from driftline.functions.shipping import ship
from driftline.functions.sizing import settle, small_side, store

PART_STEPS = 100_000
HELD_STEPS = 20_000         # of runs that a task has in Python at a time; a longer part is one by itself
# Weights of what is amiss: one comparison of sums orders by cost, then replaced, then skipped. Good for runs of two million steps.
INSERTED = 1 << 42
SKIPPED = INSERTED + 1
REPLACED = INSERTED + (1 << 21)
NEVER = 1 << 61
MOVES = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("move", T.StringType()), T.StructField("stage", T.StringType()), T.StructField("expected", T.StringType())]))


@dataclass
class Workflow:
    """Nodes in a fixed order with the stage each stands for, the nodes that may follow each, and those a run may begin and end with."""

    stages: dict[str, str]
    follows: dict[str, list[str]]
    begin: list[str]
    end: list[str]
    labels: list[str] = field(init=False)
    between: np.ndarray = field(init=False)     # weight of the nodes skipped from one node (0: before the first) to another (last: after the end)
    ways: dict[tuple[int, int], list[str]] = field(init=False)

    def __post_init__(self):
        names = list(self.stages)
        number = {n: k for k, n in enumerate(names, 1)}
        size = len(names) + 2
        after = {0: sorted(number[n] for n in self.begin), size - 1: []}
        for n in names:
            after[number[n]] = sorted(number[m] for m in self.follows.get(n, [])) + ([size - 1] if n in self.end else [])
        self.labels = [self.stages[n] for n in names]
        self.between, self.ways = np.full((size, size), NEVER, np.int64), {}
        for start in range(size):
            seen: dict[int, list[int]] = {}
            front = [(k, []) for k in after[start]]
            while front:                        # breadth first, earlier listed nodes first
                new = []
                for k, way in front:
                    if k not in seen:
                        seen[k] = way
                        new += [(m, [*way, k]) for m in after[k]]
                front = new
            for k, way in seen.items():
                self.between[start, k] = SKIPPED * len(way)
                self.ways[start, k] = [self.labels[m - 1] for m in way]
        if self.between[0, -1] >= NEVER:
            raise ValueError("no way through the workflow")

    def layers(self, stages: list[str | None], before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least weights at every node after each step, starting from ``before``, and where each came from (-1: the step is inserted)."""
        nodes = len(self.labels) + 1
        hop = self.between[:nodes, 1:nodes]
        price: dict[str | None, np.ndarray] = {}
        now, came = before.copy(), np.full((len(stages), nodes), -1, np.int16)
        for i, stage in enumerate(stages):
            if stage not in price:
                price[stage] = np.array([0 if stage == label else REPLACED for label in self.labels], np.int64)
            ways = now[:, None] + hop
            origin = ways.argmin(0)
            taken = ways[origin, np.arange(nodes - 1)] + price[stage]
            left = now + INSERTED
            better = taken <= left[1:]
            came[i, 1:][better] = origin[better]
            left[1:][better] = taken[better]
            now = np.minimum(left, NEVER)
        return now, came, before

    def first(self) -> np.ndarray:
        out = np.full(len(self.labels) + 1, NEVER, np.int64)
        out[0] = 0
        return out

    def table(self, stages: list[str | None]) -> np.ndarray:
        """Least weight from each node before the steps to each node after them."""
        nodes = len(self.labels) + 1
        rows = []
        for k in range(nodes):
            begin = np.full(nodes, NEVER, np.int64)
            begin[k] = 0
            rows.append(self.layers(stages, begin)[0])
        return np.stack(rows)

    def last(self, weights: np.ndarray) -> int:
        """The node a run with these weights is best taken to end at."""
        return int((weights + self.between[:len(weights), -1]).argmin())

    def origins(self, came: np.ndarray) -> np.ndarray:
        """For each node after the steps, the node before them."""
        at = np.arange(came.shape[1])
        for row in came[::-1]:
            at = np.where(row[at] >= 0, row[at], at)
        return at

    def moves(self, stages: list[str | None], steps: list[int], came: np.ndarray, node: int, close: bool) -> list[dict]:
        """What each step is and what is skipped before it, for a run that is at ``node`` after them; with ``close`` also what is skipped to the end."""
        out = []
        if close:
            out += [{"at": steps[-1] + 1, "move": "skipped", "stage": None, "expected": e} for e in reversed(self.ways[node, len(self.labels) + 1])]
        for stage, step, row in zip(reversed(stages), reversed(steps), came[::-1]):
            origin = int(row[node])
            if origin < 0:
                out.append({"at": step, "move": "inserted", "stage": stage, "expected": None})
                continue
            label = self.labels[node - 1]
            out.append({"at": step, "move": "matched" if stage == label else "replaced", "stage": stage, "expected": label})
            out += [{"at": step, "move": "skipped", "stage": None, "expected": e} for e in reversed(self.ways[origin, node])]
            node = origin
        return out[::-1]


def line(expected: list[str]) -> Workflow:
    """The workflow that is one straight sequence."""
    names = [f"{k}" for k in range(len(expected))]
    return Workflow(dict(zip(names, expected)), {a: [b] for a, b in zip(names, names[1:])}, names[:1], names[-1:])


def align_runs(df: DataFrame, workflow: Workflow, part_steps: int | None = None) -> DataFrame:
    """The moves of every run: its keys, at, move, stage and expected, in the order of ``at``.

    ``at`` is the number of the step; a skipped stage has that of the step it is missing before, or one more than the last. Steps without a
    number are left out; a stage that is null or unknown to the workflow matches nothing.
    """
    ship(df.sparkSession)
    size = part_steps or PART_STEPS
    key = run_key(df)
    placed = df.where("step IS NOT NULL").select(*key, F.col("step").cast("long").alias("step"), "stage").withColumn("_part", F.floor((F.col("step") - 1) / size))
    parts = placed.groupBy(*key, "_part").agg(F.array_sort(F.collect_list(F.struct("step", "stage"))).alias("_steps"))
    runs = parts.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    cut = settle(runs)
    if cut.isEmpty():
        return _inline(_told(parts, workflow, key), key)
    parts = store(parts)
    long = F.struct(*key) == F.col("_long")     # equal structs may hold nulls
    long_keys = small_side(settle(cut.select(F.struct(*key).alias("_long"))))
    short = _told(parts.join(long_keys, long, "left_anti"), workflow, key)
    return _inline(short.unionByName(_cut(store(parts.join(long_keys, long, "left_semi")), workflow, key)), key)


def _inline(told: DataFrame, key: list[str]) -> DataFrame:
    return told.select(*key, F.inline("_moves"))


def pieces(batch: pa.RecordBatch, at: int):
    """Consecutive slices of a batch whose lists in column ``at`` come to ``HELD_STEPS`` steps at most, or are a single one."""
    before = batch.column(at).offsets.to_numpy()
    start = 0
    while start < batch.num_rows:
        to = max(start + 1, int(np.searchsorted(before, before[start] + HELD_STEPS, "right")) - 1)
        yield batch.slice(start, to - start)
        start = to


def _each(rows: DataFrame, key: list[str], more: list[T.StructField], compute) -> DataFrame:
    """``compute(stages, steps, row)`` for every part; gives the keys, the part and what it returns."""
    kept = [*key, "_part"]
    extra = [c for c in rows.columns if c not in (*kept, "_steps")]
    rows = rows.select(*kept, "_steps", *extra)
    schema = T.StructType([*(rows.schema[c] for c in kept), *more])
    arrow = T.StructType(more)

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(arrow)
        for batch in (part for whole in batches for part in pieces(whole, len(kept))):
            steps = batch.column(len(kept)).to_pylist()
            given = [batch.column(k).to_pylist() for k in range(len(kept) + 1, batch.num_columns)]
            got = [compute([s["stage"] for s in own], [s["step"] for s in own], *(g[i] for g in given)) for i, own in enumerate(steps)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *(pa.array([g[k] for g in got], f.type) for k, f in enumerate(kinds))], names=schema.names)

    return rows.mapInArrow(work, schema)


def _told(parts: DataFrame, workflow: Workflow, key: list[str]) -> DataFrame:
    """Moves of runs of one part."""
    def tell(stages, steps):
        weights, came, _ = workflow.layers(stages, workflow.first())
        return (workflow.moves(stages, steps, came, workflow.last(weights), True),)

    return _each(parts, key, [T.StructField("_moves", MOVES)], tell)


def _cut(parts: DataFrame, workflow: Workflow, key: list[str]) -> DataFrame:
    longs, whole = T.ArrayType(T.LongType()), T.LongType()
    nodes = len(workflow.labels) + 1
    tables = _each(parts, key, [T.StructField("table", longs)], lambda stages, steps: (workflow.table(stages).ravel().tolist(),))

    def chain(rows: DataFrame, value: str, kind: T.DataType, walk) -> DataFrame:
        """``walk`` over a run's parts in order; a part's row is as small as the workflow, however many steps it stands for."""
        held = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_part", value))).alias("_all"))
        held = held.withColumn("_part", F.lit(0).cast("long")).withColumnRenamed("_all", "_rows")
        out = T.ArrayType(T.StructType([T.StructField("_part", T.LongType()), T.StructField("given", kind)]))
        schema = T.StructType([*(held.schema[c] for c in key), T.StructField("_out", out)])

        def work(batches):
            from pyspark.sql.pandas.types import to_arrow_type

            for batch in batches:
                got = [[{"_part": r["_part"], "given": g} for r, g in zip(own, walk([r[value] for r in own]))] for own in batch.column(len(key)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(key)], pa.array(got, to_arrow_type(out))], names=schema.names)

        return held.select(*key, "_rows").mapInArrow(work, schema).select(*key, F.inline("_out"))

    def onward(own: list) -> list:
        now, out = workflow.first(), []
        for t in own:
            out.append(now.tolist())
            now = np.minimum((now[:, None] + np.array(t, np.int64).reshape(nodes, nodes)).min(0), NEVER)
        return out

    def backward(own: list) -> list:
        """Origins of a part's end nodes, last its best end: the end node of each part."""
        node, out = own[-1][-1], []
        for origins in reversed(own):
            out.append(node)
            node = origins[node]
        return out[::-1]

    def again(rows: DataFrame, given: DataFrame) -> DataFrame:
        names = [*key, "_part"]
        other = given.select(F.struct(*names).alias("_of"), "given")
        return rows.drop("given").join(other, F.struct(*names) == F.col("_of")).drop("_of")

    def from_where(stages, steps, before):
        weights, came, _ = workflow.layers(stages, np.array(before, np.int64))
        return ([*workflow.origins(came).tolist(), workflow.last(weights)],)

    starts = store(again(parts, chain(tables, "table", longs, onward)))
    ends = chain(_each(starts, key, [T.StructField("origins", longs)], from_where), "origins", whole, backward)
    last = parts.groupBy(*key).agg(F.max("_part").alias("_last"))
    rows = starts.withColumnRenamed("given", "_before")
    rows = again(rows, ends)
    rows = rows.join(last.select(F.struct(*key).alias("_of"), "_last"), F.struct(*key) == F.col("_of")).drop("_of").withColumn("_close", F.col("_part") == F.col("_last")).drop("_last")

    def tell(stages, steps, before, node, close):
        _, came, _ = workflow.layers(stages, np.array(before, np.int64))
        return (workflow.moves(stages, steps, came, node, close),)

    return _each(rows.select(*key, "_part", "_steps", "_before", "given", "_close"), key, [T.StructField("_moves", MOVES)], tell)


def run_fit(moves: DataFrame) -> DataFrame:
    """Per run how many steps and stages are matched, replaced, inserted and skipped, the cost, and the share of steps and stages that match."""
    kinds = ("matched", "replaced", "inserted", "skipped")
    found = moves.groupBy(*run_key(moves)).agg(*[F.count_if(F.col("move") == k).alias(k) for k in kinds])
    cost = F.col("replaced") + F.col("inserted") + F.col("skipped")
    return found.withColumns({"cost": cost, "fitness": F.col("matched") / (F.col("matched") + cost)})
