import random
import re
from collections import Counter

import numpy as np
import pytest
from driftline.llm import aligning, chat, components, near_texts, near_vectors, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_components(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(500, 560)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(900, 900), (7, 901)]
    ids = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(ids)}
    pairs = {(at[max(e)], at[min(e)]) for e in edges}
    want = {3: 3, 4: 4} | {ids[i]: ids[r] for i, r in enumerate(brute_components(len(ids), lambda i, j: (i, j) in pairs))}
    links = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    assert {r.id: r.component for r in components.components(links).collect()} == want
    assert components.components(links.limit(0)).count() == 0


def near_copies(rng, groups, size, words):
    """Groups of texts at similarities around the threshold."""
    out = []
    for g in range(groups):
        base = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(max(1, words // 9))):
                copy[rng.randrange(len(copy))] = "n" + str(rng.randrange(1000))
            out.append(" ".join(copy))
    return out


def shingle_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


@pytest.mark.parametrize("width,block", [(2, 1500), (2, 7), (5, 1500)])
def test_near_texts_by_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(near_texts, "BLOCK_TEXTS", block)
    rng = random.Random(width)
    texts = near_copies(rng, 4, 5, 60) + near_copies(rng, 1, 40, 90) + near_copies(rng, 2, 4, 2000)
    texts += ["One", "one", "", None, " \t\n", "two words", "TWO  WORDS", "two words x", "É a", "é a", texts[0], texts[0].upper(), "w " * 40_000, "w " * 39_000]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, texts[k], 1) for i, k in enumerate(order)] + [(0, texts[order[0]], 1), (None, texts[0], 1), (None, None, 1)], "doc_id long, text string, n_shingles int")
    sets = [shingle_set(texts[k], width) for k in order]
    want = brute_components(len(order), lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    got = near_texts.near_groups(docs, width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        [(i, len(sets[i]), want[i], want[i] == i) for i in [*range(len(order)), 0]] + [(None, len(shingle_set(texts[0], width)), None, True), (None, 0, None, True)])


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f g", "s"), (2, "a b c d e f g", "t"), (2, "a b c d e f g", "u"), (4, "other", "s"), (4, "other", "s"), (5, None, None), (None, "a b c d e f g", "v"), (None, None, None),
            (6, "one text of an id that has two", "s"), (6, "and another that is nothing like it", "s"), (6, "", "s"), (1, "not at all the same", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    out = [tuple(r) for r in near_texts.keep_one(docs).collect()]
    assert near_texts.keep_one(docs).columns == docs.columns
    assert Counter((r[0], r[1]) for r in out) == Counter([(2, rows[0][1]), (4, "other"), (5, None), *[(r[0], r[1]) for r in rows[-4:]], (None, rows[0][1]), (None, None)])
    assert near_texts.near_groups(docs.limit(0)).count() == near_texts.keep_one(docs.limit(0)).count() == 0


def test_roots_are_exact():
    rng = np.random.default_rng(6)
    for _ in range(30):
        base = [np.sort(rng.choice(2000, 60, False)).astype(np.uint64) for _ in range(6)]
        sets = []
        for _ in range(60):
            s = base[rng.integers(6)].copy()
            s[:rng.integers(16)] += np.uint64(5000 + rng.integers(100))
            sets.append(np.unique(s))
        want = brute_components(60, lambda i, j: near_texts.linked(sets[i], sets[j], 80))
        assert near_texts.roots_of(sets, 80).tolist() == want


@pytest.mark.parametrize("block", [1024, 3])
def test_near_vectors_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = []
    for _ in range(60):
        v = rng.normal(size=16)
        rows += [v + rng.normal(size=16) * s for s in rng.uniform(0.1, 0.35, 4)]
    rows += [rows[0]] * 3 + [rows[1] * 1e-30, rows[2] * 1e30, -rows[3]]
    rows = [[float(x) for x in np.float32(r)] for r in rows]
    odd = [None, [], [0.0] * 16, [float("nan")] + rows[0][1:], [float("inf")] + rows[0][1:], [None] + rows[0][1:], rows[0][:15], rows[1][:15]]
    x = np.array(rows)
    x = x / np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = brute_components(len(rows), lambda i, j: near[i, j])
    table = [(i, r, 1) for i, r in enumerate(rows)] + [(1000 + i, r, 1) for i, r in enumerate(odd)] + [(None, rows[0], 1)]
    got = near_vectors.link_vectors(spark.createDataFrame(table, "vec_id long, embedding array<float>, kept int")).collect()
    assert len(got) == len(table)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        elif r.vec_id < 1000:
            assert (r.n_links, r.component_id, r.kept) == (near[r.vec_id].sum(), want[r.vec_id], want[r.vec_id] == r.vec_id), r.vec_id
        else:
            short = r.vec_id >= 1006 and np.dot(x[0][:15], x[1][:15]) / np.linalg.norm(x[0][:15]) / np.linalg.norm(x[1][:15]) >= 0.95
            assert r.n_links == int(short) and r.component_id == (1006 if short else r.vec_id)
    assert near_vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold share a cell and pass the count nearly always."""
    rng = np.random.default_rng(9)
    a = near_vectors.unit(rng.normal(size=(3000, 64)))
    side = rng.normal(size=a.shape)
    side = near_vectors.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.9501 * a + np.sqrt(1 - 0.9501 ** 2) * side
    index = near_vectors.fit(a, 1_000_000)
    shared = (near_vectors.keys_of(index, a) == near_vectors.keys_of(index, b)).any(axis=1)
    along = near_vectors.counting(64)
    hits = (np.abs(a @ along - b @ along) <= near_vectors.WINDOW * np.sqrt(0.1)).sum(1)
    assert shared.mean() > 0.99 and (hits >= near_vectors.least_count()).mean() > 0.99
    far = (np.abs(a @ along - a[::-1] @ along) <= near_vectors.WINDOW * np.sqrt(0.1)).sum(1)
    assert (far >= near_vectors.least_count()).mean() < 0.001


@pytest.mark.parametrize("common", [0.9, 0.8, 0.97])
def test_recall_at_the_threshold_of_dense_vectors(common):
    """So it is where all vectors have one direction in common."""
    rng = np.random.default_rng(10)
    unit = near_vectors.unit
    mean = unit(rng.normal(size=(1, 64)))
    apart = lambda x: unit(x - (x @ mean.T) * mean)      # noqa: E731
    u = apart(rng.normal(size=(3000, 64)))
    v = apart(rng.normal(size=u.shape))
    v = unit(v - (v * u).sum(1, keepdims=True) * u)
    inner = 1 - 0.0499 / (1 - common)                     # cosine of the rests at a cosine of 0.9501
    a, b = (np.sqrt(common) * mean + np.sqrt(1 - common) * x for x in (u, inner * u + np.sqrt(1 - inner ** 2) * v))
    assert np.allclose((a * b).sum(1), 0.9501)
    index = near_vectors.fit(a, 10_000_000)
    shared = (near_vectors.keys_of(index, a) == near_vectors.keys_of(index, b)).any(axis=1)
    assert len(index.directions) <= near_vectors.MOST_TABLES and shared.mean() > 0.99


def brute_align(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = aligning.MATCH if a[i - 1] == b[j - 1] else aligning.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] + aligning.GAP, h[i][j - 1] + aligning.GAP)
            best = max(best, h[i][j])
    return best / (aligning.MATCH * len(a))


def test_alignment_scores():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, 14))] for _ in range(2))
        share, first, last = aligning.align(a, b)
        assert share == brute_align(a, b) and 0 <= first <= last <= len(b)
        assert brute_align(a, b[first:last]) == share or share == 0


def test_leaks_by_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["w%d" % i for i in range(3000)] + ["the", "of"] * 400
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]      # noqa: E731
    items = {i: text(rng.randint(12, 40)) for i in range(12)} | {50: ["Only", "two"], 51: [], 52: ["ÉTÉ", "à", "la", "plage", "grande"]}
    docs = {i: text(rng.randint(0, 300)) for i in range(60)}
    for i in range(0, 40):
        copy = list(items[i % 12])
        for _ in range(i % 4 * len(copy) // 12):
            k = rng.randrange(len(copy))
            copy[k:k + 1] = rng.choice([[], ["zz"], [copy[k], "yy"]])
        docs[i] = docs[i][:100] + [w.upper() for w in copy] + docs[i][100:]
    docs |= {60: ["only", "TWO"], 61: [], 62: ["été", "à", "la", "　plage", "grande"], 63: text(30_000) + items[3], 64: items[5][:len(items[5]) // 4]}
    rows = [(k, " ".join(w) if k % 2 else "\n".join(w), 1) for k, w in docs.items()] + [(None, None, 1), (70, "", 1), (1, " ".join(docs[1]), 1)]
    frame = spark.createDataFrame(rows, "key long, text string, score int")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(None, "w1 w2 w3"), (0, " ".join(items[0])), (53, None)], "item_id long, text string")
    got = {(r.key, r.item_id): r for r in aligning.find_leaks(frame, bench).collect()}
    want = {}
    for k, t, _ in rows:
        for i, w in items.items():
            a, b = [x.lower() for x in w], aligning.words(t)
            share = aligning.align(a, b)[0] if a else 0
            if share >= aligning.LEAST_SCORE:
                want[k, i] = share
    assert set(got) == set(want)
    for pair, r in got.items():
        assert r.score == pytest.approx(want[pair])
        part = aligning.words(dict((k, t) for k, t, _ in rows)[pair[0]])[r.first_word:r.last_word + 1]
        assert aligning.align([x.lower() for x in items[pair[1]]], part)[0] == pytest.approx(r.score)
    assert aligning.find_leaks(frame, bench.limit(0)).count() == aligning.find_leaks(frame.limit(0), bench).count() == 0
    clean = aligning.without_leaks(frame.withColumnRenamed("key", "doc_id").withColumnRenamed("score", "_key"), bench).collect()
    assert {r["_key"] for r in clean} == {1}
    assert Counter(r.doc_id for r in clean) == Counter(k for k, _, _ in rows if not any(p[0] == k for p in want))


def test_leaks_edited_beside_an_exact_copy(spark):
    rng = random.Random(5)
    items = {i: ["i%dw%d" % (i, k) for k in range(n)] for i, n in enumerate((40, 15, 38))}
    edited = {i: [v if k % 4 else "zz%d" % k for k, v in enumerate(w)] for i, w in items.items()}
    rows = [(10 * i + j, " ".join(["before"] * 9 + w + ["after"] * 9)) for i in items for j, w in enumerate((items[i], edited[i]))]
    docs = spark.createDataFrame(rows, "key long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r.key, r.item_id) for r in aligning.find_leaks(docs, bench).collect()}
    assert got == {(k, i) for k, t in rows for i, w in items.items() if aligning.align(w, t.split())[0] >= aligning.LEAST_SCORE}
    assert {(1, 0), (11, 1), (21, 2)} <= got
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert aligning.ceiling(a, b) >= aligning.align(a, b)[0]


def test_no_edit_that_scores_enough_hides_a_leak(spark):
    """Every second or third word changed, words put in after every word or two, short items inside texts, frequent words all over."""
    rng = random.Random(12)
    common = ["the", "of", "and", "to"]
    items = {n: [rng.choice(common) if rng.random() < 0.6 else "i%dw%d" % (n, k) for k in range(n)] for n in (1, 2, 3, 4, 14, 15, 16, 26, 38)}
    items |= {100: common * 5, 101: ["hello", "world"]}
    edits = [lambda k, w: [w], lambda k, w: [w] if k % 3 else ["zz"], lambda k, w: [w] if k % 2 else ["zz"], lambda k, w: [w, "in"], lambda k, w: [w, "in"] if k % 2 else [w],
             lambda k, w: [] if k % 3 == 2 else [w], lambda k, w: [w] if rng.random() < 0.75 else rng.choice([[], ["zz"], [w, "yy"], ["the"]])]
    rows = []
    for w in items.values():
        for e in edits + [edits[-1]] * 6:
            body = [v for k, x in enumerate(w) for v in e(k, x)]
            rows.append((len(rows), " ".join(["b%d" % rng.randrange(99) for _ in range(rng.randrange(60))] + body + [rng.choice([*common, "after"]) for _ in range(rng.randrange(60))])))
    rows += [(900, "they say hello world to all"), (901, "hello"), (902, "the")]
    docs = spark.createDataFrame(rows, "key long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r.key, r.item_id): round(r.score, 9) for r in aligning.find_leaks(docs, bench).collect()}
    want = {(k, i): round(share, 9) for k, t in rows for i, w in items.items() if (share := aligning.align(w, t.split())[0]) >= aligning.LEAST_SCORE}
    assert got == want and (900, 101) in got and len(want) > 100


def test_benchmark_in_several_passes(spark, monkeypatch):
    rows = [(1, "a b c d e f g h"), (2, "x y z"), (3, "a b c d q r s t u v")]
    docs, bench = spark.createDataFrame(rows, "key long, text string"), spark.createDataFrame([(1, "a b c d e f"), (2, "q r s t u v")], "item_id long, text string")
    once = Counter(map(tuple, aligning.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(aligning, "MAX_SEEDS", 2)
    assert Counter(map(tuple, aligning.find_leaks(docs, bench).collect())) == once and len(once) == 3


def test_preference_pairs(spark):
    t = lambda *turns: [dict(zip(("role", "text"), x)) for x in turns]      # noqa: E731
    rows = [(1, t(("user", "q"), ("assistant", "a")), t(("user", "q"), ("assistant", "b")), "x"), (2, t(("user", "q")), t(("user", "q")), "x"), (3, None, t(("assistant", "é")), "x"), (4, [], [], "x"),
            (5, t(("user", "q"), ("assistant", None)), t(("user", "q")), "x"), (1, t((None, "q")), t(("user", "q")), "x"), (None, t(("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d" * 100_000)), t(("user", "z")), "x")]
    kind = "array<struct<role:string,text:string>>"
    got = chat.format_pairs(spark.createDataFrame(rows, f"pair_id long, chosen {kind}, rejected {kind}, prompt string")).collect()
    assert len(got) == len(rows)
    text = lambda turns: "".join(f"<|{x['role'] or ''}|>\n{x['text'] or ''}\n<|end|>\n" for x in turns)      # noqa: E731
    for r, (pair, chosen, rejected, _) in zip(got, rows):
        chosen, rejected = ([{k: v or "" for k, v in x.items()} for x in side or []] for side in (chosen, rejected))
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        assert (r.pair_id, r.prompt_turns, r.prompt, r.chosen, r.rejected) == (pair, n, text(chosen[:n]), text(chosen[n:]), text(rejected[n:]))
        for spans, side, turns in ((r.chosen_mask, r.chosen, chosen[n:]), (r.rejected_mask, r.rejected, rejected[n:])):
            parts = [side[int(a):int(b)] for a, b in (s.split("-") for s in spans.split(",") if s)]
            assert parts == [x["text"] + chat.END for x in turns if x["role"] == "assistant"]


def test_conversations_of_odd_rows(spark):
    rows = [(1, 0, "user", "q"), (1, 0, "user", "q"), (1, 2, "assistant", "a"), (1, 1, None, None), (2, 0, "assistant", "b"), (3, 0, "user", "alone"), (None, 0, "user", "x"), (4, None, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.conversations(turns).collect()}
    assert convs == {1: [("user", "q"), ("", ""), ("assistant", "a")], 2: [("assistant", "b")], 3: [("user", "alone")]}
    pairs = {r.pair_id: r for r in chat.mismatched_answers(chat.conversations(turns)).collect()}
    assert set(pairs) == {1, 2} and pairs[1].rejected[-1].text == "b" and pairs[2].rejected[-1].text == "a"
    for none in (turns.limit(0), turns.where("conv_id = 3")):
        assert chat.format_pairs(chat.mismatched_answers(chat.conversations(none))).count() == 0


def test_seeds_are_chosen_by_counts_over_all_texts(spark):
    """45,000 texts and a benchmark of several passes; pairs do not go from one text to the next."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["a", "b", "cc", "Dd", "\u00e9"]) for _ in range(rnd.randrange(4))) for _ in range(45_000)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string")
    want = {}
    for t in texts:
        w = aligning.words(t)
        for g in [(x,) for x in w] + list(zip(w, w[1:])):
            want[g] = want.get(g, 0) + 1
    asked = [*want, ("never",), ("never", "a")]
    hashes = {g: int(shingles.rolling(shingles.word_hashes([" ".join(g).encode()])[0], len(g)).view(np.int64)[0]) for g in asked}
    wanted = spark.createDataFrame([(len(g), hashes[g]) for g in asked], "width int, hash long")
    for most in (aligning.MAX_SEEDS, 9):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(aligning, "MAX_SEEDS", most)
            got = {(r["width"], r["hash"]): r["n"] for r in aligning.frequencies(frame, wanted).collect()}
        assert got == {(len(g), hashes[g]): n for g, n in want.items()}
