"""Alignment of runs with a workflow that branches and loops."""

import heapq
import random

import pytest
import pyarrow as pa
from driftline.operators import conformance as W
from driftline.operators.paths import path_distance
from pyspark.sql import functions as F
from traces import trace

FLOW = W.Workflow({"in": "a", "left": "b", "right": "c", "again": "d", "twin": "b", "out": "e"},
                  {"in": ["left", "right"], "left": ["again", "twin"], "right": ["again"], "again": ["in", "out"], "twin": ["out"]}, ["in", "right"], ["out"])


def least_cost(flow, stages):
    """Dijkstra over (steps taken, node), one move at a time."""
    after = {None: flow.begin, **{n: flow.follows.get(n, []) for n in flow.stages}}
    todo, seen = [(0, 0, 0, "")], set()
    nodes = {"": None, **{n: n for n in flow.stages}}
    while todo:
        cost, replaced, i, name = heapq.heappop(todo)
        if (i, name) in seen:
            continue
        seen.add((i, name))
        if i == len(stages) and name in flow.end:
            return cost, replaced
        if i < len(stages):
            heapq.heappush(todo, (cost + 1, replaced, i + 1, name))
        for n in after[nodes[name]]:
            heapq.heappush(todo, (cost + 1, replaced, i, n))
            if i < len(stages):
                same = stages[i] == flow.stages[n]
                heapq.heappush(todo, (cost + (not same), replaced + (not same), i + 1, n))


def runs():
    chance = random.Random(2)
    return {f"s{k}": [chance.choice(["a", "b", "c", "d", "e", "x"]) for _ in range(chance.randrange(1, 30))] for k in range(40)} | {
        "clean": list("acdabbe"), "loop": list("acdacdabbe"), "one": ["e"], "hot": [chance.choice("abcde") for _ in range(400)]}


@pytest.mark.parametrize("part", [None, 7, 1])
def test_moves_are_the_cheapest_and_do_not_depend_on_cuts(spark, part):
    given = runs()
    df = trace(spark, given).withColumn("stage", F.when(F.col("stage") != "x", F.col("stage")))
    out: dict = {}
    for r in W.align_runs(df, FLOW, part).collect():
        out.setdefault(r["session_id"], []).append(r)
    assert set(out) == set(given)
    if part is not None:
        whole = {tuple(r) for r in W.align_runs(df, FLOW).select("session_id", "at", "move", "stage", "expected").collect()}
        assert {(r["session_id"], r["at"], r["move"], r["stage"], r["expected"]) for own in out.values() for r in own} == whole
    fits = {r["session_id"]: r for r in W.run_fit(W.align_runs(df, FLOW, part)).collect()}
    for name, stages in given.items():
        stages = [None if s == "x" else s for s in stages]
        taken = sorted((r for r in out[name] if r["move"] != "skipped"), key=lambda r: r["at"])
        assert [(r["at"], r["stage"]) for r in taken] == list(enumerate(stages, 1))
        cost, replaced = least_cost(FLOW, stages)
        assert (fits[name]["cost"], fits[name]["replaced"]) == (cost, replaced)
    assert fits["clean"]["cost"] == fits["loop"]["cost"] == 0 and fits["clean"]["fitness"] == 1


def test_a_line_costs_what_the_path_distance_says(spark):
    df = trace(spark, {k: v for k, v in runs().items() if len(v) < 40})
    for part in (None, 4):
        a = {r["session_id"]: r["cost"] for r in W.run_fit(W.align_runs(df, W.line(list("abcde")), part)).collect()}
        assert a == {r["session_id"]: r["distance"] for r in path_distance(df, list("abcde")).collect()}


def test_no_runs_and_no_way(spark):
    df = trace(spark, {"a": ["a"]})
    assert W.align_runs(df.limit(0), FLOW).count() == W.run_fit(W.align_runs(df.limit(0), FLOW)).count() == 0
    with pytest.raises(ValueError):
        W.Workflow({"a": "a", "b": "b"}, {}, ["a"], ["b"])


def test_steps_are_held_in_bounded_pieces(monkeypatch):
    from driftline.operators import conformance

    monkeypatch.setattr(conformance, "HELD_STEPS", 10)
    lists = [[0] * n for n in (3, 7, 1, 0, 25, 4, 4, 4)]
    batch = pa.record_batch([pa.array(range(8)), pa.array(lists)], names=["run", "_steps"])
    for part in (batch, batch.slice(1, 6)):
        got = list(conformance.pieces(part, 1))
        assert pa.Table.from_batches(got).equals(pa.Table.from_batches([part]))
        assert all(p.num_rows == 1 or sum(map(len, p.column(1).to_pylist())) <= 10 for p in got)
    assert [p.num_rows for p in conformance.pieces(batch, 1)] == [2, 2, 1, 2, 1]
