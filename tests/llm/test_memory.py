"""What Python workers hold of a machine's memory."""

import re
from pathlib import Path

import pytest
from driftline.llm import near_texts, registry
from pyspark.sql import functions as F


def held_mb():
    return int(re.search(r"\nRssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="Linux only")
def test_a_task_gives_its_memory_back():
    """Freed blocks below one that lives on stay with the process unless they are handed back."""
    lives_on = []

    def work(batches):
        for n in batches:
            blocks = [bytearray(8_000) for _ in range(n)]
            lives_on.append(bytearray(8_000))
            del blocks
            yield held_mb()

    before = held_mb()
    assert list(work([12_000]))[0] - before > 60
    run = registry.tidy(work)
    assert list(run([12_000])) and held_mb() - before < 30


def test_batches_are_bounded_by_bytes(spark):
    """Two thousand long texts are no single batch, and a text longer than a batch stays whole."""
    kept = {k: spark.conf.get(k) for k in (registry.ARROW_ROWS, registry.ARROW_BYTES)}
    try:
        docs = spark.range(2_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), F.when(F.col("id") == 7, 400_000).otherwise(900).cast("int")).alias("text"))
        near_texts.sketch(docs, 5)

        def sizes(batches):
            import pyarrow as pa
            for b in batches:
                yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

        seen = docs.select("text").mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in seen) == 2_000
        assert max(r["bytes"] for r in seen if r["bytes"] < 4_400_000) < 3 << 20 and max(r["bytes"] for r in seen) >= 4_400_000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
