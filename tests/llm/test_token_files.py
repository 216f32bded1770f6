import zlib

import numpy as np
import pytest
import tokenizers
from driftline.llm import token_files as tf
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
TEXTS = ["plain words, more words.", "", None, "  two  blanks ", "tab\t after\n\n lines \n end", "don't DON'T 12 345!!", "<|endoftext|> x<|endoftext|>", "naïve façade — ünï 漢字 \U0001f600",
         "a\0b c", "nbsp\u00a0 x", "\x1c odd \x1d\x85 marks", "ſ K’s l'été", "x" * 5000, "word " * 3000, "|| a| $$$ %%%\nA!! B!!", "³² ½ 𝟛 a", "\n", " "]


LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_special_tokens_are_read_as_the_library_does():
    assert whole("a <|endoftext|> b") == [64, 220, 50256, 275]
    assert tf.Encoder(PATH, "uint16").batch(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZé'stredml 0\t\n.-—“Ж漢ªµ½×\u00a0\u0085\x1c\x00|<>"), max_size=30), max_size=4))
def test_any_mix_of_letters_marks_and_blanks(texts):
    assert [x.tolist() for x in tf.Encoder(PATH, "uint16").batch(texts)] == [whole(t) for t in texts]


def test_words_give_the_ids_of_whole_texts():
    enc = tf.Encoder(PATH, "uint16")
    for _ in range(2):
        for t, got in zip(TEXTS, enc.batch(TEXTS)):
            assert list(got) == whole(t), t


def test_full_store_of_words(monkeypatch):
    monkeypatch.setattr(tf, "KNOWN_WORDS", 2)
    enc = tf.Encoder(PATH, "uint32")
    for _ in range(3):
        assert [list(x) for x in enc.batch(TEXTS)] == [whole(t) for t in TEXTS]
    assert len(enc.words) <= 2


def test_round_trip(spark, tmp_path):
    rows = [(i * 37 % 101, t, "n") for i, t in enumerate(TEXTS * 3)] + [(None, "no id", "n"), (5, "b", "n"), (5, "a", "n"), (5, None, "n"), (5, "a", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    shards = tf.write_shards(docs, str(tmp_path), PATH, length=16, per_batch=4)
    order = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, at = [], 0
    for i, t in order:
        ids = whole(t) + [tf.END_ID]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(tf.read_documents(spark, str(tmp_path), shards).collect(), key=lambda r: r.start)
    assert [tuple(r)[:4] for r in got] == want
    assert shards.agg({"n_tokens": "sum"}).first()[0] == at

    # Every sequence by place; masks cover the ids and nothing else.
    flat = [x for _, t in order for x in whole(t) + [tf.END_ID]]
    seen = []
    for s in sorted(shards.collect(), key=lambda r: r.shard):
        for k in range(-(-s.n_tokens // 16)):
            ids, mask = tf.sequence(str(tmp_path), s.shard, k)
            assert len(ids) == len(mask) == 16
            seen += ids[mask].tolist()
    assert seen == flat


def test_no_documents(spark):
    assert tf.write_and_read(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
