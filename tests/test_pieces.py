"""Pieces of long groups give what whole groups give."""

import random
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pytest
from driftline.functions import sizing
from driftline.functions.ordered import (
    SEG, last_known, last_rows, previous, running, running_max, running_min, running_sum, segment)
from driftline.functions.quantile import quantiles
from driftline.operators import attribution as A
from driftline.operators import nearest
from driftline.operators.normalize import window_names, window_summary
from driftline.operators.paths import path_distance
from pyspark.sql import functions as F
from traces import START, trace


def rows(spark, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(600):
        session = rnd.choice(["hot", "hot", "hot", "b", "c", f"s{rnd.randrange(40)}"])
        value = rnd.choice([None, rnd.randrange(50)])
        out.append((session, START + timedelta(seconds=rnd.randrange(200)), i, value))
    return spark.createDataFrame(out, "session_id string, ts timestamp, step_id bigint, x int")


@pytest.mark.parametrize("seed", [1, 2])
def test_running_in_pieces(spark, seed):
    df = rows(spark, seed)
    cut = segment(df, ["session_id"], ["ts", "step_id"], 20)
    assert SEG in cut.columns and cut.where("session_id = 'hot'").select(SEG).distinct().count() > 5
    wanted = {
        "p": previous("x"), "l": last_known("x"), "li": last_known("x", inclusive=True), "s": running_sum("x"),
        "sx": running_sum("x", inclusive=False), "hi": running_max("x"), "lo": running_min("x", inclusive=True),
        "k": last_rows("x", 3)}
    names = ["step_id", *wanted]
    whole = sorted(map(tuple, running(df, wanted).select(names).collect()))
    parts = sorted(map(tuple, running(cut, wanted).select(names).collect()))
    assert whole == parts


def test_no_long_group_no_piece(spark):
    df = rows(spark, 3)
    assert segment(df, ["session_id"], ["ts", "step_id"], 10_000).columns == df.columns


@pytest.mark.parametrize("limit", [10_000, 25])
def test_quantiles_are_exact(spark, limit):
    rnd = np.random.default_rng(5)
    groups = {"a": rnd.normal(size=500), "b": rnd.integers(0, 5, 300).astype(float), "c": np.array([7.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    out = {r["g"]: r for r in quantiles(df, ["g"], "v", {"lo": 0.05, "mid": 0.5, "hi": 0.95}, limit).collect()}
    for g, vs in groups.items():
        for name, p in (("lo", 0.05), ("mid", 0.5), ("hi", 0.95)):
            assert out[g][name] == pytest.approx(np.quantile(vs, p), abs=1e-12)


def test_a_null_group_keeps_its_quantiles(spark):
    rnd = np.random.default_rng(7)
    rows = [(g, float(v)) for g in ("a", None) for v in rnd.normal(size=200)]
    df = spark.createDataFrame(rows, "g string, v double")
    few, many = ({r["g"]: (r["lo"], r["hi"]) for r in quantiles(df, ["g"], "v", {"lo": 0.05, "hi": 0.813}, limit).collect()}
                 for limit in (10, 10_000))
    assert few == many and set(few) == {"a", None}


def test_a_null_key_is_cut(spark):
    df = rows(spark, 9).withColumn("session_id", F.when(F.col("session_id") != "hot", F.col("session_id")))
    cut = segment(df, ["session_id"], ["ts", "step_id"], 10)
    assert cut.where("session_id IS NULL").select(SEG).distinct().count() > 5
    wanted = {"p": previous("x"), "s": running_sum("x"), "k": last_rows("x", 3)}
    whole, parts = (sorted(map(tuple, running(d, wanted).select("step_id", *wanted).collect())) for d in (df, cut))
    assert whole == parts


def test_quantiles_of_everything(spark):
    df = spark.range(1001).select((F.col("id") * 3 % 1001).cast("double").alias("v"))
    assert quantiles(df, [], "v", {"m": 0.5}, 100).first()["m"] == 500.0


def test_path_in_parts(spark):
    rnd = random.Random(4)
    df = trace(spark, {f"s{i}": [rnd.choice(["signup", "view", "click", "purchase", "error"]) for _ in range(rnd.randrange(1, 25))]
                       for i in range(30)})
    expected = ["signup", "view", "click", "purchase"]
    whole = sorted(map(tuple, path_distance(df, expected).collect()))
    assert whole == sorted(map(tuple, path_distance(df, expected, list_steps=4).collect()))


def test_a_window_is_one_row(spark):
    df = trace(spark, {"a": ["signup", "view", "click", "purchase", "error"]}).withColumn("window_id", F.lit(1))
    far = df.withColumn("step", F.col("step") + 99_998)
    out = window_summary(far).collect()
    assert [(r["first_step"], r["last_step"], r["n_rows"]) for r in out] == [(99_999, 100_003, 5)]
    names = window_names(far).orderBy("place").collect()
    assert [(r["place"], r["name"]) for r in names] == list(enumerate(["signup", "view", "click", "purchase", "error"], 1))


def test_sketches_of_parts_give_the_quantiles_of_the_whole(spark, monkeypatch):
    """Heavy ties, a null group, NaN, one group in every part; only values inside the brackets are ranked."""
    from driftline.functions import quantile
    rnd = random.Random(5)
    rows = [(p, rnd.choice(["x", "x", "x", "y", None]), float(rnd.choice([rnd.gauss(0, 1), 3.0, -rnd.randrange(4)]))) for p in range(6) for _ in range(2000)]
    rows += [(1, "x", None), (1, "y", float("nan")), (2, "alone", 7.0), (3, "none", None)]
    df = spark.createDataFrame(rows, "part int, g string, v double")
    probs = {"a": 0.05, "m": 0.5, "b": 0.95, "end": 1.0}
    held = quantile.value_sketches(df, ["part", "g"], "v")
    ranked = []
    plain = quantile.segment
    monkeypatch.setattr(quantile, "segment", lambda d, *a: ranked.append(d.agg(F.sum("_w")).first()[0]) or plain(d, *a))
    told = lambda d: sorted((str(r["g"]), *(round(r[c], 12) for c in probs)) for r in d.collect())
    some = F.col("part").between(1, 4)
    got = told(quantile.sketched_quantiles(held.where(some), df.where(some), ["g"], "v", probs))
    assert got == told(quantiles(df.where(some), ["g"], "v", probs)) and len(got) == 4
    assert len(ranked) == 1 and ranked[0] < 8000 * 1.5
    monkeypatch.setattr(quantile, "SKETCH_SLACK", -0.04)      # brackets that miss are widened
    assert told(quantile.sketched_quantiles(held, df, ["g"], "v", probs)) == told(quantiles(df, ["g"], "v", probs))


def test_sequences_by_plain_search(spark):
    """Cut and whole runs alike, one of a single stage for very long, steps without a stage, a stage no run has."""
    from itertools import product

    from driftline.operators import sequences
    chance = random.Random(7)
    runs = {f"s{k}": [chance.choice(["a", "b", "c", "d"]) for _ in range(chance.randrange(1, 12))] for k in range(30)} | {"long": ["a"] * 3000 + ["b"], "none": [{"stage": None}]}
    df = trace(spark, runs)
    paths = {k: [s if isinstance(s, str) else None for s in v] for k, v in runs.items()}
    holds = lambda q, path: all(s in it for it in [iter(path)] for s in q)
    share = {q: sum(holds(q, p) for p in paths.values()) / len(paths) for k in (1, 2, 3) for q in product("abcd", repeat=k)}
    often = {q: n for q, n in share.items() if n >= 0.35}
    want = sorted((q, n) for q, n in often.items() if not any(len(o) > len(q) and holds(q, o) for o in often))
    asked = [("a", "b"), ("b", "a", "c"), ("a", "x"), ("d",)]
    lost = sorted((k, ">".join(q)) for k, p in paths.items() for q in asked if not holds(q, p))
    for part in (None, 3):
        assert sequences.frequent_sequences(df, 0.35, 3, part) == want and want
        assert sorted((r["session_id"], r["sequence"]) for r in sequences.lacking(df, asked, part).collect()) == lost
    assert sequences.frequent_sequences(df.limit(0), 0.1) == [] and sequences.lacking(df.limit(0), asked).count() == 0


def test_near_cases_are_earlier_and_resolved(spark):
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(40, 16))
    rows = [(i, [float(x) for x in base[i % 40] + rnd.normal(size=16) * 0.05], f"c{i % 40}" if i % 3 else None) for i in range(160)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>, cause string")
    queries = df.select(F.col("id").alias("query_id"), F.col("id").alias("at"), "vector")
    memory = df.select(F.col("id").alias("case_id"), F.col("id").alias("at"), "vector", "cause")
    near = A.recall_near(queries, memory, 2, 16).collect()
    assert all(r["case_id"] < r["query_id"] and r["cause"] for r in near)
    found = {(r["query_id"], r["case_id"]) for r in near}
    wanted = {(i, j) for i in range(160) for j in range(i - 40, -1, -40) if j % 3}
    best = {i: {j for q, j in wanted if q == i} for i, _ in wanted}
    hit = sum(len([j for j in js if (i, j) in found]) for i, js in best.items() if len(js) <= 2)
    assert hit >= 0.9 * sum(len(js) for js in best.values() if len(js) <= 2)


def test_nearest_cases_by_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    vectors = np.concatenate([rnd.normal(size=(150, 16)), rnd.normal(size=(150, 16)) * 0.8 + 1])
    vectors[40], vectors[7] = vectors[3], 0
    odd = [(900, 5, None, "c"), (901, 5, [1.0] * 3, "c"), (902, 5, [float("nan")] * 16, "c"), (903, None, [1.0] * 16, "c")]
    rows = [(i, int(t), [float(x) for x in v], f"c{i % 5}" if i % 3 else None) for i, (v, t) in enumerate(zip(vectors, rnd.integers(0, 100, 300)))] + odd
    df = spark.createDataFrame(rows + rows[:20], "id bigint, at int, vector array<double>, cause string")
    queries = df.select(F.col("id").alias("query_id"), F.col("at").cast("bigint").alias("at"), "vector")
    memory = df.select(F.col("id").alias("case_id"), "at", "vector", "cause")
    long = {i for i in range(300) if vectors[i].any()}
    length = np.linalg.norm(vectors, axis=1)
    want = set()
    for q in long:
        near = sorted((-round(float(vectors[q] @ vectors[c] / (length[q] * length[c])), 9), c) for c in long if rows[c][3] and rows[c][1] < rows[q][1])
        want |= {(q, c, rows[c][3], place) for place, (_, c) in enumerate(near[:3], 1)}
    for size in (nearest.CASE_ROWS, 32):
        monkeypatch.setattr(nearest, "CASE_ROWS", size)
        monkeypatch.setattr(nearest, "QUERY_ROWS", size)
        got = A.recall_near(queries, memory, 3, 16).collect()
        assert len(got) == len(want) and {(r["query_id"], r["case_id"], r["cause"], r["place"]) for r in got} == want
    assert A.recall_near(queries.limit(0), memory, 3, 16).count() == A.recall_near(queries, memory.limit(0), 3, 16).count() == 0


def test_nearest_rules_out_blocks_and_pairs(spark, monkeypatch):
    """Tight clusters, equal vectors, and one neighbourhood with most of the cases."""
    monkeypatch.setattr(nearest, "CASE_ROWS", 32)
    rnd = np.random.default_rng(11)
    centres = rnd.normal(size=(12, 16))
    vectors = np.concatenate([centres[i % 12] + rnd.normal(size=(1, 16)) * 0.05 for i in range(240)] + [centres[:1]] * 60 + [centres[:1] + rnd.normal(size=(1, 16)) * 0.02 for _ in range(300)])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    queries = df.select(F.col("id").alias("query_id"), F.col("id").alias("at"), "vector")
    memory = df.select(F.col("id").alias("case_id"), F.col("id").alias("at"), "vector", F.lit("c").alias("cause"))
    seen = spark.sparkContext.accumulator(0)
    got = {(r["query_id"], r["place"]): r["case_id"] for r in A.recall_near(queries, memory, 2, 16, seen).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = np.round(unit @ unit.T, 9)
    want = {(q, p): c for q in range(1, 600) for p, c in enumerate(sorted(range(q), key=lambda c: (-cosine[q, c], c))[:2], 1)}
    assert got == want
    assert seen.value < 0.4 * 600 * 599 / 2


def test_nearest_multiplies_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(nearest, "VALUES", 64)
    rnd = np.random.default_rng(12)
    a, b = rnd.normal(size=(9, 16)), rnd.normal(size=(7, 16))
    i, j = (x.ravel() for x in np.mgrid[0:9, 0:7])
    assert np.array_equal(nearest.products(a, b, i, j), np.einsum("ij,ij->i", a[i], b[j]))


def test_nearest_sends_vectors_once_a_tile(spark, monkeypatch):
    """Directions without structure, of which no block can be ruled out: rows go to tiles, not to blocks."""
    monkeypatch.setattr(nearest, "CASE_ROWS", 16)
    rnd = np.random.default_rng(13)
    vectors = rnd.normal(size=(300, 16))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    queries = df.select(F.col("id").alias("query_id"), F.col("id").alias("at"), "vector")
    memory = df.select(F.col("id").alias("case_id"), F.col("id").alias("at"), "vector", F.lit("c").alias("cause"))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = np.round(unit @ unit.T, 9)
    want = {(q, c) for q in range(300) for c in sorted(range(q), key=lambda c: (-cosine[q, c], c))[:2]}
    stored = []
    monkeypatch.setattr(nearest, "store", lambda df: stored.append(sizing.store(df)) or stored[-1])
    for rows, tiles in ((100, 3), (1000, 1)):
        monkeypatch.setattr(nearest, "QUERY_ROWS", rows)
        stored.clear()
        got = A.recall_near(queries, memory, 2, 16).collect()
        assert {(r["query_id"], r["case_id"]) for r in got} == want
        assert max(x.count() for x in stored if "query_id" in x.columns) <= 300 * (tiles + 1) * 2


def test_nearest_compares_few_pairs_to_the_end_without_structure(spark):
    """Directions without structure: all pairs are multiplied in single precision, few in double."""
    n = 1500
    vectors = np.random.default_rng(14).normal(size=(n, 64))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    queries = df.select(F.col("id").alias("query_id"), F.col("id").alias("at"), "vector")
    memory = df.select(F.col("id").alias("case_id"), F.col("id").alias("at"), "vector", F.lit("c").alias("cause"))
    seen = spark.sparkContext.accumulator(0)
    got = {(r["query_id"], r["case_id"]) for r in A.recall_near(queries, memory, 3, 64, seen).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = np.round(unit @ unit.T, 9)
    assert got == {(q, c) for q in range(n) for c in sorted(range(q), key=lambda c: (-cosine[q, c], c))[:3]}
    assert seen.value < 0.05 * n * (n - 1) / 2


def test_nearest_tells_apart_what_single_precision_cannot(spark, monkeypatch):
    """Cosines that differ from the eighth digit on, equal ones, single precision input, and few found pairs kept at a time."""
    for name, size in (("SOME", 32), ("FOUND", 16), ("CASE_ROWS", 32), ("QUERY_ROWS", 100)):
        monkeypatch.setattr(nearest, name, size)
    rnd = np.random.default_rng(15)
    vectors = rnd.normal(size=(1, 16)) + rnd.normal(size=(240, 16)) * np.repeat([0, 1e-4, 3e-4], 80)[:, None]
    for kind, values in (("double", vectors), ("float", vectors.astype(np.float32).astype(float))):
        df = spark.createDataFrame([(i * 7 % 240, [float(x) for x in v]) for i, v in enumerate(values)], f"id bigint, vector array<{kind}>")
        queries = df.select(F.col("id").alias("query_id"), F.col("id").alias("at"), "vector")
        memory = df.select(F.col("id").alias("case_id"), F.col("id").alias("at"), "vector", F.lit("c").alias("cause"))
        unit = (values / np.linalg.norm(values, axis=1, keepdims=True))[np.argsort(np.arange(240) * 7 % 240)]
        cosine = unit @ unit.T
        got = {}
        for r in A.recall_near(queries, memory, 3, 16).collect():
            got.setdefault(r["query_id"], {})[r["place"]] = (r["case_id"], r["cosine"])
        for q in range(240):
            want = sorted(((round(float(cosine[q, c]), 9), -c) for c in range(q)), reverse=True)[:3]
            assert np.allclose([got[q][p][1] for p in sorted(got.get(q, {}))], [v for v, _ in want], atol=1.1e-9, rtol=0)
            assert all(c < q and abs(cosine[q, c] - v) < 1e-9 for c, v in got.get(q, {}).values())
            places = [(-got[q][p][1], got[q][p][0]) for p in sorted(got.get(q, {}))]
            assert places == sorted(set(places))


def test_beyond_the_bound_nothing_is_hinted(spark):
    df = spark.range(50)
    assert sizing.is_small(df, max_rows=50) and not sizing.is_small(df, max_rows=49)
    assert not sizing.is_small(df, max_bytes=10)
    assert sizing.small_side(df, max_rows=49) is df


def test_running_does_not_depend_on_row_order(spark):
    df = rows(spark, 6)
    a = running(df, {"s": running_sum("x")}).select("step_id", "s")
    b = running(df.orderBy(F.desc("step_id")), {"s": running_sum("x")}).select("step_id", "s")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
