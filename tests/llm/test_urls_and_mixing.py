import hashlib
import re
from collections import Counter, defaultdict

import harness
import pytest
from driftline.functions import sizing
from driftline.llm import mixing, queries, urls

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_beside_its_sql(spark, name):
    assert harness.compare(queries.QUERIES[name](spark, SF), harness.oracle(SF), queries.ORACLES[name]) is None


URLS = ["http://a.b.com/", "HTTP://A.Example.COM/en/x?q", "https://www.example.com/en/", "https://x.www.example.com/en", "http://net/es/1", "http://spam.net/fr/#x",
        "http://xnet/es/", "http://com", "com/", "", None, "http:///es/", "x://a..com/y://b.net/es/", "http://u@h.net:80/es/", "é://É.net/fr/é", "http://" + "a." * 3000 + "net/es/" + "x" * 50_000]


def brute_url(url, rules, default):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[3:]) if fits else (host, path, None, default)


@pytest.mark.parametrize("rows", [None, 0])
def test_urls_by_brute_force(spark, monkeypatch, rows):
    if rows is not None:                                    # no broadcast: the join shuffles
        monkeypatch.setattr(urls, "small_side", lambda df: df)
    rules = [*urls.RULES, ("com", "/e", "block"), ("example.com", "/e", "allow"), ("net", "/es/", "allow"), ("b.net", "", "block")]
    table = spark.createDataFrame([*rules, (None, "/", "block"), rules[0]], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS * 2)] + [(0, URLS[0], "old")], "page_id long, url string, host string")
    got = urls.judge_urls(pages, table).collect()
    want = Counter((i, *brute_url(u, rules, "allow")) for i, u in [*enumerate(URLS * 2), (0, URLS[0])])
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in urls.judge_urls(pages, none, "block").collect()] == [(None, "block")]
    assert urls.judge_urls(pages.limit(0), spark.createDataFrame(urls.RULES, none.schema)).count() == 0


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


DOCS = [(i, ("a", "b", "c", None, "B", "d")[i % 6] if i % 3 else "a", None if i % 17 == 0 else " ".join(["w"] * (i * 7 % 23)), "x") for i in range(300)]
DOCS += [DOCS[4]] * 3 + [(None, "b", "one two\x0bthree", "y"), (900, "empty", "", "z"), (901, "long", "v " * 60_000, "z")]


def test_mix_takes_each_source_to_its_target(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, source string, text string, taken string")
    rows = mixing.draw(docs.select("doc_id", "source", mixing.count_words("text").alias("size"))).collect()
    assert len(rows) == len(DOCS)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, s, t, _ in DOCS:
        sizes[s] += len((t or "").split())
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
    want = brute_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[r.source])
    assert {s: int(want[s]) for s in sizes} == dict(taken)
    again = mixing.draw(docs.repartition(7).select("doc_id", "source", mixing.count_words("text").alias("size"))).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mixed_documents_are_whole_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, source string, text string, _epochs string")
    out = mixing.mix(docs).collect()
    assert set(map(tuple, out)) <= set(DOCS) and max(Counter(map(tuple, out)).values()) <= 2 * 4
    size, got = defaultdict(int), defaultdict(int)
    for _, s, t, _ in DOCS:
        size[s] += len((t or "").split())
    for r in out:
        got[r.source] += len((r.text or "").split())
    want = brute_targets(size)
    for s in size:
        largest = max((len((t or "").split()) for _, x, t, _ in DOCS if x == s), default=0)
        assert abs(got[s] - want[s]) <= 4 * largest / 2 + 1


def test_order_is_the_hash(spark):
    docs = spark.createDataFrame([(i, "s", 1) for i in range(40)] + [(100 + i, "t", 1) for i in range(40)], "doc_id long, source string, size long")
    once = [r.doc_id for r in mixing.draw(docs).where("source = 't' AND taken > 0").collect()]
    keys = sorted(range(100, 140), key=lambda i: hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest())
    assert sorted(once) == sorted(keys[:len(once)])


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.draw(none.select("doc_id", "source", mixing.count_words("text").alias("size"))).count() == 0
    assert mixing.mix(none).count() == 0


def test_rest_does_not_need_this_folder():
    from pathlib import Path

    root = Path(sizing.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if path.parent.name != "llm":
            assert not re.search(r"\bllm\b", path.read_text()), path
