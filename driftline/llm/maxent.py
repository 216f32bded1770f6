"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

The probability of a word is that of its class, times that of its leaf within the class, times its share of the leaf. Classes and
leaves are softmaxes over the unigram shares and the sum of hashed feature rows (the word before, the word before that
alone, and both). Words with at least a 2**-17 part of all training tokens (so 2**17 at most)
fill the first leaves in order of frequency, by equal mass; all other words, seen or not, have leaves by a checksum of their last three bytes. A
word's share of its leaf is add-one smoothed, with one unseen word in each leaf of that kind, so all probabilities sum to 1.

Training: in each of ``ROUNDS`` rounds every task goes once through its share of the training texts from common weights, by gradient steps over
``CHUNK`` tokens, and gives back the rows it changed; rows are averaged by how often each task met them. All training texts take part, each in
one round. Only the weights (2**16 rows of 20) and the frequent words reach the driver. Counts of other words stay a table and are joined; none is a hot key.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.sizing import store
from driftline.llm.languages import in_fold
from driftline.llm.registry import query, ready, shielded, slices, table, widened

SIDE = 20                       # classes, and leaves in each
COMMON_LEAVES, RARE_LEAVES = 300, 100
FREQUENT = 1 << 17              # a word is frequent with at least this part of all tokens
ROWS = 1 << 16                  # of hashed weights
ROUNDS = 2
CHUNK = 8192                    # tokens of a gradient step
RATE = 0.7
TASK_TOKENS = 4_000_000         # a training task sees about so many tokens at least, if there are more tasks than cores
BLOCK = 256                     # rows of weights that travel together
BATCH_BYTES = 4 << 20           # of text that is handled at a time
MOST_WORDS = 300_000            # distinct words a task counts before it passes them on
END = b"\n"                     # the token after the last word; no word holds a blank


def form(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % RARE_LEAVES


@dataclass
class Vocabulary:
    """Frequent words with number, leaf and count, and the mass of every leaf."""

    number: dict[bytes, int]
    leaf: np.ndarray            # of each number
    seen: np.ndarray            # log10(count + 1)
    total: np.ndarray           # of each leaf: counts plus one of its words
    tokens: int
    distinct: int

    def offsets(self) -> np.ndarray:
        """Logarithms of the shares of classes (row 0) and of leaves in class c (row c + 1)."""
        mass = self.total.reshape(SIDE, SIDE).astype(float)
        rows = np.vstack([mass.sum(1), mass])
        sums = rows.sum(1, keepdims=True)
        with np.errstate(divide="ignore"):
            logs = np.log(rows / np.where(sums, sums, 1))
        return np.maximum(logs, -60).astype(np.float32)

    def encode(self, texts: list[bytes | None]):
        """Of all texts one after the other: context numbers and leaves of their tokens; how many tokens each text has; and, for ``known``, all words."""
        flat, sizes = [], []
        for t in texts:
            words = t.lower().split() if t else []      # bytes: A-Z only, the six ASCII blanks
            sizes.append(len(words) + 1)
            flat += words
            flat.append(END)
        sizes = np.array(sizes, np.int64)
        ids = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        known = ids >= 0
        leaf = np.empty(len(ids), np.int64)
        leaf[known] = self.leaf[ids[known]]
        rare = np.flatnonzero(~known).tolist()
        forms = np.array([form(flat[k]) for k in rare], np.int64)
        leaf[~known] = COMMON_LEAVES + forms
        numbers, ids = ids, np.where(known, ids, 0)
        ids[~known] = len(self.number) + forms
        return ids, leaf, sizes, (flat, numbers, rare)

    def known(self, sizes: np.ndarray, words: tuple):
        """Of each text: how many tokens are frequent, their log counts, and the other words with their counts."""
        flat, numbers, rare = words
        first = np.cumsum(sizes) - sizes
        hit = numbers >= 0
        seen = np.where(hit, self.seen[np.maximum(numbers, 0)] if len(self.seen) else 0.0, 0.0)
        cuts = np.searchsorted(rare, np.r_[first, len(flat)]).tolist()
        others = [Counter([flat[k] for k in rare[a:b]]) for a, b in zip(cuts, cuts[1:])]
        return np.add.reduceat(hit.astype(np.int64), first), np.add.reduceat(seen, first), others

    def contexts(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the token before each token, and of the one before that; texts begin with numbers of their own."""
        start = len(self.number) + RARE_LEAVES
        first = np.cumsum(sizes) - sizes
        one = np.r_[start, ids[:-1]]
        two = np.r_[start + 1, start + 1, ids[:-2]][:len(ids)]
        one[first] = start
        two[first] = start + 1
        second = first[sizes > 1] + 1
        two[second] = start
        return one, two


def features(level: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Weight rows of each token at a level: 0 for the class, c + 1 for the leaf in class c."""
    x, a, b = (np.asarray(v).astype(np.uint64) + np.uint64(1) for v in (level, one, two))
    x, a, b = x * np.uint64(0x9E3779B97F4A7C15), a * np.uint64(0xC2B2AE3D27D4EB4F), b * np.uint64(0x165667B19E3779F9)
    keys = np.stack([x + a, x ^ b, (x + a) ^ (b << np.uint64(1))], axis=1)
    keys ^= keys >> np.uint64(29)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    return (keys >> np.uint64(48)).astype(np.uint16)


class Learner:
    """Weights with the sums of squared gradients that set each row's step."""

    def __init__(self, weights: np.ndarray, squares: np.ndarray, offsets: np.ndarray):
        self.weights, self.squares, self.offsets = weights, squares, offsets
        self.met = np.zeros(len(weights), np.float32)

    def shares(self, rows: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Logarithms of the softmax."""
        z = self.offsets[level]
        for k in range(rows.shape[1]):
            z += np.take(self.weights, rows[:, k], axis=0)
        np.clip(z, -80, 80, out=z)              # so that no exponential overflows
        z -= np.log(np.exp(z) @ np.ones(z.shape[1], np.float32))[:, None]
        return z

    def gradient(self, rows: np.ndarray, level: np.ndarray, target: np.ndarray):
        """Slope of minus the summed log shares of ``target``: the rows it touches, each row's slope, how often each was met."""
        slope = np.exp(self.shares(rows, level))
        slope[np.arange(len(target)), target] -= 1
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(flat[order].astype(np.int32)) != 0])
        pairs = slope[order // rows.shape[1]].view(np.result_type(slope.dtype, np.complex64))      # columns two by two: half the steps
        return flat[order[first]], np.add.reduceat(pairs, first, axis=0).view(slope.dtype), np.diff(np.r_[first, len(flat)])

    def step(self, rows: np.ndarray, level: np.ndarray, target: np.ndarray, rate: float = RATE) -> None:
        touched, slope, times = self.gradient(rows, level, target)
        self.squares[touched] += np.einsum("ij,ij->i", slope, slope)
        self.weights[touched] -= rate / np.sqrt(1 + self.squares[touched])[:, None] * slope
        self.met[touched] += times

    def learn(self, one: np.ndarray, two: np.ndarray, leaf: np.ndarray) -> None:
        for at in range(0, len(leaf), CHUNK):
            a, b, c = one[at:at + CHUNK], two[at:at + CHUNK], leaf[at:at + CHUNK]
            level = np.r_[np.zeros(len(c), np.int64), c // SIDE + 1]
            self.step(features(level, np.r_[a, a], np.r_[b, b]), level, np.r_[c // SIDE, c % SIDE])

    def score(self, one: np.ndarray, two: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Log10 of the probability of each leaf in its context."""
        out = np.empty(len(leaf))
        for at in range(0, len(leaf), CHUNK):
            a, b, c = one[at:at + CHUNK], two[at:at + CHUNK], leaf[at:at + CHUNK]
            zero, level, k = np.zeros(len(c), np.int64), c // SIDE + 1, np.arange(len(c))
            out[at:at + CHUNK] = self.shares(features(zero, a, b), zero)[k, c // SIDE]
            out[at:at + CHUNK] += self.shares(features(level, a, b), level)[k, c % SIDE]
        return out / math.log(10)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, END once for each text."""
    ready(docs.sparkSession)

    def add(batches):
        held: Counter = Counter()
        give = lambda: pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for text in batch.column(0):
                held.update(text.as_py().lower().split() if text.is_valid else ())
            held[END] += batch.num_rows
            if len(held) > MOST_WORDS:
                yield give()
                held.clear()
        yield give()

    return store(docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(add, "word binary, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = int(total["tokens"] or 0), int(total["distinct"])
    is_common = F.col("n") * FREQUENT >= tokens
    rows = counts.where(is_common).toArrow()                    # at most FREQUENT of them
    words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    words, n = [words[k] for k in order], n[order]
    mass = np.cumsum(n) - n
    leaf = (mass * COMMON_LEAVES // max(1, int(n.sum()))).astype(np.int64)
    leaves = np.zeros(SIDE * SIDE, np.int64)
    np.add.at(leaves, leaf, n + 1)
    leaves[COMMON_LEAVES:] += 1                                 # the unseen word
    rare = F.crc32(F.substring("word", -3, 3)) % RARE_LEAVES
    for r in counts.where(~is_common).groupBy(rare.alias("form")).agg(F.sum(F.col("n") + 1).alias("n")).collect():
        leaves[COMMON_LEAVES + r["form"]] += r["n"]
    return Vocabulary({w: k for k, w in enumerate(words)}, leaf, np.log10(n + 1.0), leaves, tokens, distinct)


def one_round(docs: DataFrame, words, weights: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and squares after every task of ``docs`` (text as bytes) went through its texts."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast((weights, squares))

    def learn(batches):
        own = Learner(*(x.copy() for x in common.value), words.value.offsets())
        for batch in batches:
            for part in slices(batch, 0, BATCH_BYTES):
                ids, leaf, sizes, _ = words.value.encode(part.column(0).to_pylist())
                own.learn(*words.value.contexts(ids, sizes), leaf)
        for at in range(0, ROWS, BLOCK):
            rows = slice(at, at + BLOCK)
            met = np.flatnonzero(own.met[rows])
            if len(met):
                change = (own.weights[rows] - common.value[0][rows])[met].astype(np.float16)
                grown = (own.squares[rows] - common.value[1][rows])[met]
                yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (met.astype(np.uint8), own.met[rows][met], change, grown))],
                                                 names=["block", "rows", "met", "change", "grown"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, rows, met, change, grown in zip(*(c.to_pylist() for c in batch.columns)):
                held = sums.setdefault(block, np.zeros((BLOCK, SIDE + 2)))
                rows, met = np.frombuffer(rows, np.uint8), np.frombuffer(met, np.float32).astype(float)
                held[rows, :SIDE] += met[:, None] * np.frombuffer(change, np.float16).reshape(-1, SIDE)
                held[rows, SIDE] += met
                held[rows, SIDE + 1] += np.frombuffer(grown, np.float32)
        for block, held in sums.items():
            held[:, :SIDE] /= np.maximum(held[:, SIDE:SIDE + 1], 1)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([held[:, [*range(SIDE), SIDE + 1]].astype(np.float32).tobytes()], pa.binary())], names=["block", "sum"])

    changes = docs.mapInArrow(learn, "block int, rows binary, met binary, change binary, grown binary")
    parts = min(ROWS // BLOCK, int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = changes.repartition(parts, "block").mapInArrow(add, "block int, sum binary").collect()       # ROWS / BLOCK rows at most
    weights, squares = weights.copy(), squares.copy()
    for block, data in got:
        rows, data = slice(block * BLOCK, (block + 1) * BLOCK), np.frombuffer(data, np.float32).reshape(BLOCK, SIDE + 1)
        weights[rows] += data[:, :SIDE]
        squares[rows] += data[:, SIDE]
    common.unpersist()
    return weights, squares


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights learnt from (doc_id, text), each text in one of the rounds."""
    spark = docs.sparkSession
    weights, squares = np.zeros((ROWS, SIDE), np.float32), np.zeros(ROWS, np.float32)
    sent = spark.sparkContext.broadcast(words)
    turn = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(rounds))
    tasks = max(spark.sparkContext.defaultParallelism, words.tokens // TASK_TOKENS)
    for k in range(rounds):
        own = docs.where(turn == k).select(F.col("text").cast("binary").alias("text")).coalesce(tasks)
        weights, squares = one_round(own, sent, weights, squares)
    return weights


def score(docs: DataFrame, words: Vocabulary, weights: np.ndarray, counts: DataFrame) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score, replacing columns of these names."""
    spark = docs.sparkSession
    ready(spark)
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    docs = docs.drop(*added)
    rows = shielded(docs, "text")
    inner = rows.withColumn("_bytes", F.col("text").cast("binary"))
    kept = T.StructType(rows.schema.fields)
    schema = widened(kept, _row=T.LongType(), _tokens=T.LongType(), _known=T.LongType(), _seen=T.DoubleType(), _leaves=T.DoubleType(),
                     _words=T.ArrayType(T.BinaryType()), _times=T.ArrayType(T.LongType()))
    sent = spark.sparkContext.broadcast((words, weights))

    def judge(batches):
        from pyspark import TaskContext

        known, w = sent.value
        own = Learner(w, np.empty(0), known.offsets())
        row = TaskContext.get().partitionId() << 40
        logs = np.log10(np.maximum(known.total, 1))
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, BATCH_BYTES):
                ids, leaf, sizes, own_words = known.encode(part.column(part.num_columns - 1).to_pylist())
                n_known, seen, others = known.known(sizes, own_words)
                value = own.score(*known.contexts(ids, sizes), leaf) - logs[leaf]
                sums = np.add.reduceat(value, np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:-1], pa.array(np.arange(row, row + part.num_rows)), pa.array(sizes), pa.array(n_known), pa.array(seen), pa.array(sums),
                    pa.array([list(o) for o in others], pa.list_(pa.binary())), pa.array([list(o.values()) for o in others], pa.list_(pa.int64()))], names=schema.names)
                row += part.num_rows

    # Stored, since the rows are numbered as they come.
    first = store(inner.mapInArrow(judge, schema))
    rare = first.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("x")).select("_row", F.col("x._words").alias("word"), F.col("x._times").alias("times"))
    rare = rare.join(counts, "word").groupBy("_row").agg(F.sum("times").alias("_more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_plus"))
    n_all = F.log10(F.lit(float(words.tokens + words.distinct + 1)))
    seen = F.col("_seen") + F.coalesce("_plus", F.lit(0.0))
    both = first.drop("_words", "_times").join(rare, "_row", "left")
    return both.select(*rows.columns, "_tokens", (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("_known"), F.lit(words.tokens).cast("long").alias("_train"),
                       (seen - F.col("_tokens") * n_all).alias("_base"), (seen + F.col("_leaves")).alias("_score")).toDF(*docs.columns, *added)


def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``docs`` with scores by what ``training`` (doc_id, text) teaches.

    Null and empty texts are the end token alone. Rows of equal id are scored each for itself. Without training texts every word is unseen
    and ``base_score`` is 0. Columns of the added names are replaced. An empty table gives an empty one. Training runs when this is called.
    """
    training = training.select("doc_id", "text")
    counts = word_counts(training)
    words = vocabulary(counts)
    return score(docs, words, train(training, words), counts)


@query()
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 7, 2)
    return score_texts(docs, docs.where(~held_out)).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
