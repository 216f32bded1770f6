"""The language model against plain counts, finite differences and the law of total probability."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from driftline.llm import maxent


def small_vocabulary():
    counts = {b"the": 40, b"cat": 11, b"sat": 7, b"mat": 5, b"dog": 1, b"log": 1, maxent.END: 9}
    n = np.array(list(counts.values()))
    common = [w for w in counts if counts[w] > 1]
    leaf = np.arange(len(common)) * 37 % maxent.COMMON_LEAVES
    total = np.zeros(maxent.SIDE ** 2, np.int64)
    np.add.at(total, leaf, np.array([counts[w] for w in common]) + 1)
    total[maxent.COMMON_LEAVES:] += 1
    for w in counts:
        if w not in common:
            total[maxent.COMMON_LEAVES + maxent.form(w)] += counts[w] + 1
    seen = np.log10([counts[w] + 1.0 for w in common])
    return counts, maxent.Vocabulary({w: k for k, w in enumerate(common)}, leaf, seen, total, int(n.sum()), len(counts))


def test_probabilities_of_all_words_sum_to_one():
    counts, words = small_vocabulary()
    chance = np.random.default_rng(1)
    learner = maxent.Learner(chance.normal(size=(maxent.ROWS, maxent.SIDE)).astype(np.float32), np.zeros(maxent.ROWS, np.float32), words.offsets())
    leaf = np.arange(maxent.SIDE ** 2)
    one, two = np.full(len(leaf), 3), np.full(len(leaf), 1)
    chances = 10 ** learner.score(one, two, leaf)
    assert abs(chances.sum() - 1) < 1e-4
    inside = np.zeros(len(leaf))                    # shares of the words of each leaf, and of its unseen word
    for w, n in counts.items():
        at = words.leaf[words.number[w]] if w in words.number else maxent.COMMON_LEAVES + maxent.form(w)
        inside[at] += (n + 1) / words.total[at]
    inside[maxent.COMMON_LEAVES:] += 1 / words.total[maxent.COMMON_LEAVES:]
    assert abs((chances * inside).sum() - 1) < 1e-4


def test_gradient_is_the_slope_of_the_loss():
    _, words = small_vocabulary()
    chance = np.random.default_rng(2)
    learner = maxent.Learner(chance.normal(size=(maxent.ROWS, maxent.SIDE)).astype(np.float64), np.zeros(maxent.ROWS), words.offsets().astype(np.float64) * 0.1)
    level = np.array([0, 3, 0, 3, 3])
    rows = maxent.features(level, np.array([1, 2, 1, 2, 5]), np.array([4, 4, 4, 4, 6]))
    target = np.array([5, 7, 1, 7, 0])
    loss = lambda: -learner.shares(rows, level)[np.arange(5), target].sum()
    touched, slope, times = learner.gradient(rows, level, target)
    assert times.sum() == rows.size and len(set(touched.tolist())) == len(touched)
    for row, own in zip(touched, slope):
        for column in (0, 1, 5, 7):
            learner.weights[row, column] += 1e-4
            up = loss()
            learner.weights[row, column] -= 2e-4
            down = loss()
            learner.weights[row, column] += 1e-4
            assert abs((up - down) / 2e-4 - own[column]) < 1e-3


def test_contexts_begin_with_each_text():
    _, words = small_vocabulary()
    ids, leaf, sizes, own = words.encode([b"The cat\x0bSAT", None, b"dog \xc3\x89 dog"])
    known, seen, others = words.known(sizes, own)
    start = len(words.number) + maxent.RARE_LEAVES
    one, two = words.contexts(ids, sizes)
    assert sizes.tolist() == [4, 1, 4] and known.tolist() == [4, 1, 1]
    assert one.tolist() == [start, *ids[:3], start, start, *ids[5:8]]
    assert two.tolist() == [start + 1, start, ids[0], ids[1], start + 1, start + 1, start, ids[5], ids[6]]
    assert others == [Counter(), Counter(), Counter({b"dog": 2, "É".encode(): 1})]


def split(text):
    return [*(text or "").encode().lower().split(), maxent.END]


@pytest.mark.parametrize("frequent", [1 << 17, 30])
def test_query_rows(spark, tmp_path, monkeypatch, frequent):
    monkeypatch.setattr(maxent, "FREQUENT", frequent)
    chance = random.Random(3)
    grammar = {"a": "b", "b": "c", "c": "d", "d": "e", "e": "a"}
    rows = [(None, "Null ID"), (7, None), (8, ""), (9, " \t"), (9, "A a É é"), (9, "A a É é")]
    for k in range(300):
        w, text = chance.choice("abcde"), []
        for _ in range(chance.randrange(1, 60)):
            text.append(w if chance.random() < 0.9 else f"rare{chance.randrange(400)}")
            w = grammar[w] if chance.random() < 0.9 else chance.choice("abcde")
        rows.append((100 + k, "  ".join(text)))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    got = maxent.op13_lm_score(spark, str(tmp_path)).collect()
    want = sorted((str(i), held(i), len(split(t)), sum(w in counts for w in split(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(t)), 6)) for i, t in rows)
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    fresh = [r for r in got if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in fresh) / sum(r["n_tokens"] for r in fresh)
    assert gain > 0.15                              # the next letter is nearly known


def test_training_learns_a_cycle():
    _, words = small_vocabulary()
    learner = maxent.Learner(np.zeros((maxent.ROWS, maxent.SIDE), np.float32), np.zeros(maxent.ROWS, np.float32), words.offsets())
    text = b"the cat sat the mat " * 400
    ids, leaf, sizes, *_ = words.encode([text])
    one, two = words.contexts(ids, sizes)
    before = learner.score(one, two, leaf).mean()
    for _ in range(3):
        learner.learn(one, two, leaf)
    assert learner.score(one, two, leaf).mean() > before / 4 and learner.met.sum() > 0


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "x y", "s", 2.0, 4), (2, "z", "t", 1.0, 5)], "doc_id long, text string, score string, _row double, _tokens int")
    out = maxent.score_texts(docs, docs.limit(0))
    assert out.columns == ["doc_id", "text", "_row", "_tokens", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert sorted((r["_row"], r["_tokens"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out.collect()) == [(1.0, 5, 2, 0, 0, 0.0), (2.0, 4, 3, 0, 0, 0.0)]
    assert maxent.score_texts(docs.limit(0), docs).count() == 0
