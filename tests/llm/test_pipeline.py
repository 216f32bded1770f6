"""The pipeline's stages on one small corpus, each against brute force on its own input."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline as cp
import numpy as np
import pytest
import tokenizers
from driftline.llm import aligning, token_files

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A tenth of a thousandth's documents with odd rows, and the real test items."""
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    text = max((r.text for r in docs.collect()), key=len)
    leak = items.orderBy("item_id").first().text.split()
    leak[len(leak) // 2] = "changed"
    odd = [(9001, None, "en", "src1", 0), (9002, "", "en", None, 0), (9003, "12 34 !!", "en", "src1", 8), (9004, text + " more", "en", "src2", 0), (9005, text, None, None, 0),
           (9006, "some words before " + " ".join(leak) + " and after", "en", "src3", 0), (9007, "a word", "en", "only", 6), (9008, "b\x00 c   d", "en", "only", 0)]
    docs.union(spark.createDataFrame(odd, SCHEMA)).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def stage(spark, docs, corpus, name):
    out = dict(cp.STAGES)[name](spark, docs, corpus)
    rows = [tuple(r) for r in out.collect()]
    return spark.createDataFrame(rows, out.schema), rows


def test_stages_in_order(spark, corpus):
    assert [n for n, _ in cp.STAGES] == ["language_id", "minhash_near_dedup", "decontamination", "mix_sources", "token_files"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]

    docs, rows = stage(spark, docs, corpus, "language_id")
    assert Counter(rows) == Counter(r for r in before if r[1] and any(c.isalpha() for c in r[1]))

    before = rows
    docs, rows = stage(spark, docs, corpus, "minhash_near_dedup")
    sets = {}
    for r in before:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
        sets[r[0]] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    near = defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
    seen, keep = set(), set()
    for a in sorted(sets):
        if a not in seen:
            keep.add(a)
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += near[x]
    assert sorted(r[0] for r in rows) == sorted(keep) and len(keep) < len(before) and set(rows) <= set(before)

    before = rows
    docs, rows = stage(spark, docs, corpus, "decontamination")
    items = [aligning.words(r.text) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    assert set(before) - set(rows) == {r for r in before if any(
        set(i) & set(w) and aligning.align(i, w)[0] >= aligning.LEAST_SCORE for w in [aligning.words(r[1])] for i in items)}
    assert 9006 not in {r[0] for r in rows} and len(rows) < len(before)

    before = rows
    docs, rows = stage(spark, docs, corpus, "mix_sources")
    size, got, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
        largest[r[3]] = max(largest[r[3]], len(re.findall(r"[^\x20\x09-\x0D]+", r[1])))
    for r in rows:
        got[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    assert set(rows) <= set(before) and max(Counter(rows).values()) <= 2
    assert abs(sum(got.values()) - 1.5 * sum(size.values())) <= sum(largest.values()) / 2 + len(size)

    before = rows
    _, rows = stage(spark, docs, corpus, "token_files")
    encode = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode
    at, want = 0, []
    for r in sorted(before, key=lambda r: (r[0], r[1].encode())):
        ids = encode(r[1], add_special_tokens=False).ids + [token_files.END_ID]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == want


def test_whole_run_and_empty_tables(spark, corpus, tmp_path):
    rows = cp.run(spark, corpus).collect()
    assert rows and cp.ORACLE_SQL is None
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
