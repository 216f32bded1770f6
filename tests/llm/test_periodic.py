"""Periodic runs against a plain search over all starts and periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import periodic


def plain_runs(words: list, least: int, times: int) -> list[tuple[int, int, int]]:
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s >= max(least, times * q):
                smallest = next(p for p in range(1, q + 1) if all(words[k] == words[k - p] for k in range(s + p, e)))
                if smallest == q:
                    found.append((s, e - s, q))
            s = max(s + 1, e - q + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_lyndon(codes: list[int]) -> list[int]:
    """Distance to the next smaller suffix."""
    n = len(codes)
    return [next((j - i for j in range(i + 1, n) if codes[j:] < codes[i:]), n - i) for i in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_lyndon_lengths_under_both_orders(codes):
    assert periodic.lyndon_lengths(codes) == plain_lyndon(codes)
    assert periodic.lyndon_lengths([-c for c in codes]) == plain_lyndon([-c for c in codes])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8), st.sampled_from([(3, 3), (6, 3), (8, 4), (24, 3)]))
def test_runs_equal_a_plain_search(blocks, bounds):
    words = [w for unit, k in blocks for w in unit * k]
    codes = np.array(words, np.int64)
    assert periodic.runs_of(codes, np.zeros(len(codes), np.int64), *bounds) == plain_runs(words, *bounds)


def test_runs_stay_within_their_document():
    words = [1, 2] * 20 + [1, 2] * 20
    doc = np.repeat([0, 1], 40)
    assert periodic.runs_of(np.array(words), doc) == [(0, 40, 2), (40, 40, 2)]


def test_stretches_that_share_a_hash_are_compared_word_by_word():
    text = np.array([5, 1, 2, 1, 2, 1, 2, 7])
    assert periodic.extended(text, 0, 8, 3, 2) == (1, 6)
    assert periodic.extended(np.array([1, 2, 1, 2]), 0, 4, 0, 2) == (0, 4)


ROWS = [(1, "a b " * 30), (1, "a b " * 30), (2, None), (None, "x " * 40), (3, ""), (4, " \n\t"), (5, "only these words"),
        (6, " ".join(random.Random(5).choice("ab") for _ in range(4000)) + " " + "c d e " * 3000),
        (7, "    \u0085 ​" + " pär​ q" * 14)]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words, 24, 3)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_query_rows(spark, tmp_path):
    chance = random.Random(9)
    ids = [k for k in range(10_000, 10_400) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = ROWS + [(k, " ".join(chance.choice(["in", "the", "end", "of", str(j % 7)]) for j in range(chance.randrange(1, 400)))) for k in ids]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in periodic.op11_periodic_runs(spark, str(tmp_path)).collect()]
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=order) == sorted((expected(*r) for r in rows), key=order)


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "u v w " * 9, "kept", 7, "x", 3)], "doc_id long, text string, Runs string, n_words int, _0 string, _bytes int")
    out = periodic.with_runs(docs)
    assert out.columns == ["doc_id", "text", "_0", "_bytes", "n_words", "runs", "collapsed"]
    row = out.first()
    assert (row["_0"], row["n_words"], row["collapsed"]) == ("x", 27, "u v w") and [tuple(r) for r in row["runs"]] == [(0, 27, 3)]
    assert periodic.with_runs(docs.limit(0)).count() == 0
