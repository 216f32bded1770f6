"""Which texts may hold which passages: winnowed fingerprints of bytes, and a bit filter that only passages' own marks pass.

A gram of ``GRAM`` bytes has a hash; of every ``WINDOW`` grams in a row the least hash is kept. What is kept of a window depends on its bytes
alone, so a text that holds a passage of ``GRAM + WINDOW - 1`` bytes or more keeps every hash that the passage keeps, and one of them, the one fewest
passages share, stands for it. Shorter passages stand for themselves: for each of their lengths, all stretches of that length are hashed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.shipping import ship
from driftline.functions.sizing import settle, small_side, spread, store

GRAM, WINDOW = 16, 17
LONG = GRAM + WINDOW - 1
FILTER_BITS = 1 << 24           # 2 MB, sent to every task
BATCH_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Hashes:
    """Hashes of all stretches of a length in a run of bytes."""

    def __init__(self, raw: np.ndarray):
        x = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        self.doubled = [x ^ (x >> np.uint64(31))]           # of 1, 2, 4, ... bytes

    def of(self, length: int) -> np.ndarray:
        """The hash of ``length`` bytes from each place on where they fit."""
        while 2 << (len(self.doubled) - 1) <= length:
            last, step = self.doubled[-1], 1 << (len(self.doubled) - 1)
            x = last[:-step] * _ODD + last[step:] if len(last) > step else last[:0]
            self.doubled.append(x ^ (x >> np.uint64(29)))
        out, at = None, 0
        for k in range(length.bit_length()):
            if length >> k & 1:
                part = self.doubled[k][at:]
                out = part if out is None else (out[:len(part)] * _ODD + part) ^ np.uint64(length)
                at += 1 << k
        return out


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    step = 1
    while 2 * step <= width:
        x, step = np.minimum(x[:-step], x[step:]) if len(x) > step else x[:0], 2 * step
    return np.minimum(x[:len(x) - (width - step)], x[width - step:]) if width > step else x


def marks(raw: bytes) -> tuple[int, list[int]]:
    """What a passage may be known by: its length if it is short (else 0), and hashes that every text holding it has."""
    found = Hashes(np.frombuffer(raw, np.uint8))
    if len(raw) < LONG:
        return len(raw), found.of(len(raw)).view(np.int64).tolist()
    return 0, np.unique(least(found.of(GRAM), WINDOW)).view(np.int64).tolist()


def anchored(passages: DataFrame, passage_id: str) -> DataFrame:
    """(passage_id, _length, _hash): the mark fewest passages have, for each passage that is not empty."""
    ship(passages.sparkSession)
    known = passages.where(F.length("text") > 0).select(passage_id, F.col("text").cast("binary").alias("text"))
    schema = T.StructType([known.schema[passage_id], T.StructField("_length", T.IntegerType()), T.StructField("_hashes", T.ArrayType(T.LongType()))])

    def mark(batches):
        for batch in batches:
            got = [marks(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in got], pa.int32()), pa.array([h for _, h in got], pa.list_(pa.int64()))], names=schema.names)

    held = store(known.mapInArrow(mark, schema)).select(passage_id, "_length", F.explode("_hashes").alias("_hash"))
    shared = held.groupBy("_length", "_hash").agg(F.count("*").alias("_n"))
    best = held.join(shared, ["_length", "_hash"]).groupBy(passage_id).agg(F.min(F.struct("_n", "_hash", "_length")).alias("_a"))
    return settle(best.select(passage_id, "_a._length", "_a._hash"))


def bit_filter(anchors: DataFrame) -> bytes:
    """One bit for each slot some anchor falls into. Built in tasks; a row for each byte that is not zero at most reaches the driver."""
    slots = F.pmod(F.shiftrightunsigned("_hash", 40), F.lit(FILTER_BITS))
    rows = anchors.select(slots.alias("s")).distinct().groupBy(F.floor(F.col("s") / 8).alias("byte")).agg(F.sum(F.expr("shiftleft(1, cast(s % 8 as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    out[rows.column("byte").to_numpy()] = rows.column("bits").to_numpy()
    return out.tobytes()


def candidates(texts: DataFrame, anchors: DataFrame, text_id: str) -> DataFrame:
    """(text_id, text, _marks) of the texts with a mark that passes the filter: (_length, _hash) pairs, each once."""
    spark = texts.sparkSession
    ship(spark)
    lengths = sorted(r[0] for r in anchors.select("_length").distinct().collect())      # LONG of them at most
    bits = spark.sparkContext.broadcast(bit_filter(anchors))
    rows = texts.where(F.length("text") > 0).select(text_id, F.col("text").cast("binary").alias("text"))
    kind = T.ArrayType(T.StructType([T.StructField("_length", T.IntegerType()), T.StructField("_hash", T.LongType())]))
    schema = T.StructType([*rows.schema.fields, T.StructField("_marks", kind)])
    arrow = pa.list_(pa.struct([("_length", pa.int32()), ("_hash", pa.int64())]))

    def find(batches):
        known = np.frombuffer(bits.value, np.uint8)

        def held(part: pa.RecordBatch):
            texts = part.column(1).to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(texts)), sizes)
            hashes = Hashes(np.frombuffer(b"".join(texts), np.uint8))
            got: list[set] = [set() for _ in texts]
            for length in lengths:
                width = length or LONG
                found = hashes.of(length) if length else least(hashes.of(GRAM), WINDOW)
                if not len(found):
                    continue
                new = np.r_[True, found[1:] != found[:-1]] if not length else np.ones(len(found), bool)
                new[np.minimum(ends[:-1], len(found) - 1)] = True                       # a text's first window speaks for itself
                at = np.flatnonzero(new)
                s = (found[at] >> np.uint64(40)) % np.uint64(8 * len(known))
                at = at[known[s >> np.uint64(3)] >> (s & np.uint64(7)).astype(np.uint8) & 1 == 1]
                at = at[at + width <= ends[owner[at]]]                                  # within one text
                for i, h in zip(owner[at].tolist(), found[at].view(np.int64).tolist()):
                    got[i].add((length, h))
            keep = [i for i, g in enumerate(got) if g]
            if keep:
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(keep)).columns, pa.array([[{"_length": n, "_hash": h} for n, h in sorted(got[i])] for i in keep], arrow)], names=schema.names)

        for batch in batches:
            start, size = 0, 0
            for k, t in enumerate(batch.column(1)):
                size += len(t.as_buffer())
                if size >= BATCH_BYTES or k == batch.num_rows - 1:
                    yield from held(batch.slice(start, k + 1 - start))
                    start, size = k + 1, 0

    return store(spread(rows).mapInArrow(find, schema).withColumn("text", F.col("text").cast("string")))


def quoted(texts: DataFrame, passages: DataFrame, text_id: str, passage_id: str) -> DataFrame:
    """(text_id, passage_id) of all texts and the passages they hold literally, each pair once."""
    anchors = anchored(passages, passage_id)
    texts = candidates(texts, anchors, text_id).withColumn("_row", F.xxhash64("text"))
    marked = texts.select(text_id, "_row", F.explode("_marks").alias("_m")).select(text_id, "_row", "_m._length", "_m._hash")
    pairs = settle(marked.join(small_side(anchors), ["_length", "_hash"]).select(text_id, "_row", passage_id).distinct())
    known = passages.select(F.col(passage_id).alias("_p"), F.col("text").alias("_passage"))
    # Only texts with a mark are read here; few pairs are the rule, and then none of them is shuffled.
    held = texts.withColumnRenamed(text_id, "_t").withColumnRenamed("_row", "_r").select("_t", "_r", "text")
    met = small_side(pairs).join(held, F.col(text_id).eqNullSafe(F.col("_t")) & (F.col("_row") == F.col("_r")))
    return met.join(known, F.col(passage_id).eqNullSafe(F.col("_p"))).where(F.contains("text", "_passage")).select(text_id, passage_id).distinct()
