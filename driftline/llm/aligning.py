"""Benchmark decontamination: rare n-gram seeds find passages of test items, local alignment scores them.

An item's seeds are chosen so that no alignment that scores enough is without one of them, and so that they are rare in the texts. Let an item have n
words and let t be the least score. Its word pairs are seeds but for the x most frequent ones. Where two neighbouring pairs are left out, the three words of both are
a seed. An alignment that matches no seed so far has runs of at most two matches, r of them of two words, all left-out pairs, so r is at most x; with m matches and at least
(runs - 1) other columns it scores at most 2m - (m - r - 1) = m + r + 1, so m is at least t - 1 - x. Then at most n - t + 1 + x words of the item are
unmatched, and its n - t + 2 + x rarest words are seeds too. Of all x the one with the fewest expected hits is taken.

One pass over whole texts keeps the passages around seeds, twice as far as their longest item is long, since an alignment with more added words scores
too little. Every passage meets every item it has a seed in common with. Where the words alone show that
the score stays below the least one the pair goes; the others are aligned by Smith-Waterman over words, which bears changed, added
and left-out words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.sizing import small_side, store
from driftline.llm import shingles
from driftline.llm.registry import query, shielded, small_batches, table, tidy

SEED_WORDS = 3              # seeds have one to so many words
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5           # of what the item scores against itself
MAX_SEEDS = 500_000         # sent to every task (4 MB); a larger benchmark is searched in as many passes as it takes
FILTER_BITS = 20
LOW = np.uint64((1 << FILTER_BITS) - 1)


def words(text: str | None) -> list[str]:
    """Lower-case words of a text, as runs without white space."""
    return [w.lower() for w in (text or "").replace("\x1c", " ").split()]


def best_row(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(score, end in a, end in b) of the best local alignment of two word arrays; ends are exclusive."""
    best, end_a, end_b = 0, 0, 0
    row = np.zeros(len(b) + 1, np.int64)
    slope = -GAP * np.arange(len(b) + 1)
    for i, w in enumerate(a):
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(b == w, MATCH, MISMATCH))
        row = np.maximum.accumulate(new + slope) - slope        # gaps along b: the best of all places before
        at = int(row.argmax())
        if row[at] > best:
            best, end_a, end_b = int(row[at]), i + 1, at
    return best, end_a, end_b


def align(item: list[str], passage: list[str]) -> tuple[float, int, int]:
    """(score as a share of the item's own, first word, word after the last) of the part of ``passage`` most like ``item``."""
    if not item or not passage:
        return 0.0, 0, 0
    codes: dict[str, int] = {}
    a, b = (np.array([codes.setdefault(w, len(codes)) for w in x]) for x in (item, passage))
    best, end_a, end_b = best_row(a, b)
    if not best:
        return 0.0, 0, 0
    _, _, back = best_row(a[:end_a][::-1], b[:end_b][::-1])
    return best / (MATCH * len(item)), end_b - back, end_b


def most_of(known: list[bool]) -> int:
    """The highest score of any stretch of words if each known word matches and each other one costs the least it can."""
    sums = np.cumsum(np.concatenate([[0], np.where(known, MATCH, max(MISMATCH, GAP))]))
    return int((sums - np.minimum.accumulate(sums)).max())


def ceiling(item: list[str], passage: list[str]) -> float:
    """A share that the score of ``align`` never exceeds, without aligning."""
    if not item or not passage:
        return 0.0
    of_item, of_passage = set(item), set(passage)
    return min(most_of([w in of_passage for w in item]), most_of([w in of_item for w in passage])) / (MATCH * len(item))


def filtered(own: np.ndarray) -> np.ndarray:
    """Which low bits occur among sorted hashes."""
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(own & LOW).astype(np.int64)] = True
    return seen


def known(h: np.ndarray, own: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of those ``h`` that are among the sorted hashes ``own``, and which of them each is."""
    at = np.flatnonzero(seen[(h & LOW).astype(np.int64)])
    place = np.minimum(np.searchsorted(own, h[at]), len(own) - 1)
    hit = own[place] == h[at]
    return at[hit], place[hit]


def frequencies(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(width, hash, n): how often each of the words and pairs ``wanted`` (width, hash) occurs in all ``texts`` (text); those that never occur are left out."""
    passes = -(-wanted.count() // MAX_SEEDS)
    out = texts.sparkSession.createDataFrame([], "width int, hash long, n long")
    for k in range(passes):
        rows = wanted.where(F.pmod("hash", F.lit(passes)) == k).toArrow()            # MAX_SEEDS of them, about
        width, hashes = rows.column("width").to_numpy(), rows.column("hash").to_numpy().view(np.uint64)
        out = out.union(texts.select("text").mapInArrow(tidy(counter([np.sort(hashes[width == w]) for w in (1, 2)])), out.schema))
    return out.groupBy("width", "hash").agg(F.sum("n").alias("n"))


def counter(own: list[np.ndarray]):
    """Counts of words and pairs in a task's texts, given once at its end."""
    def count(batches):
        filters, n = [filtered(x) for x in own], [np.zeros(len(x), np.int64) for x in own]
        for batch in batches:
            for _, encoded in shingles.chunks(batch.column(0).to_pylist()):
                h, bounds, _, _ = shingles.word_hashes([plain(e) for e in encoded])
                last = np.zeros(len(h) + 1, bool)           # words that end a text, which no pair begins with
                last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
                for width in (1, 2):
                    runs = shingles.rolling(h, width)
                    if len(own[width - 1]) and len(runs):
                        at, place = known(runs, own[width - 1], filters[width - 1])
                        n[width - 1] += np.bincount(place if width == 1 else place[~last[at]], minlength=len(own[width - 1]))
        for width in (1, 2):
            met = np.flatnonzero(n[width - 1])
            yield pa.record_batch([pa.array(np.full(len(met), width, np.int32)), pa.array(own[width - 1][met].view(np.int64)), pa.array(n[width - 1][met])], names=["width", "hash", "n"])

    return count


def plain(encoded: bytes) -> bytes:
    """Words are told apart by ASCII white space and lower-cased within ASCII; a text with other letters is rewritten first."""
    return encoded if encoded.isascii() and b"\x1c" not in encoded else " ".join(words(encoded.decode())).encode()


def chosen(singles: list[int], pairs: list[int], least: float) -> tuple[list[int], list[int], list[int]]:
    """Places in an item whose single words, pairs and triples are its seeds, from how frequent each word and pair is; see the module."""
    n = len(singles)
    wanted = math.ceil(least * MATCH * n)
    by_pair, by_word = sorted(range(n - 1), key=lambda k: (-pairs[k], k)), sorted(range(n), key=lambda k: (singles[k], k))
    best = None
    for x in range(n):
        some = by_word[:max(1, min(n, n - wanted + 2 + x))]
        cost = sum(pairs[k] for k in by_pair[x:]) + sum(singles[k] for k in some)
        if best is None or cost < best[0]:
            best = cost, x, some
    _, x, some = best
    out = set(by_pair[:x])
    return sorted(some), sorted(by_pair[x:]), [k for k in range(n - 2) if k in out and k + 1 in out]


def seeds_of(items: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(item_id, width, seed, n_words) of rows (item_id, text): seeds of one, two or three words, rare in all ``texts`` (key, text)."""
    def hashes(text: str | None) -> np.ndarray:
        return shingles.word_hashes([" ".join(words(text)).encode()])[0]

    def spell(batches):
        for batch in batches:
            out: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = hashes(text)
                out += [(item, text, width, k, x) for width in (1, 2) for k, x in enumerate(shingles.rolling(h, width).view(np.int64).tolist())]
            cols = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["item_id", "text", "width", "place", "hash"])

    def choose(batches):
        for batch in batches:
            out = []
            for item, text, counts in zip(*(c.to_pylist() for c in batch.columns)):
                h = hashes(text)
                size = {1: [0] * len(h), 2: [0] * max(0, len(h) - 1)}
                for c in counts:
                    size[c["width"]][c["place"]] = c["n"]
                for width, places in enumerate(chosen(size[1], size[2], least), 1):
                    runs = shingles.rolling(h, width).view(np.int64)
                    out += {(item, width, int(runs[k]), len(h)) for k in places}
            cols = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["item_id", "width", "seed", "n_words"])

    spelt = items.select("item_id", "text").mapInArrow(tidy(spell), "item_id long, text string, width int, place long, hash long")
    wanted = store(spelt.select("width", "hash").distinct())
    counted = spelt.join(frequencies(texts, wanted), ["width", "hash"], "left").groupBy("item_id", "text").agg(
        F.collect_list(F.struct("width", "place", F.coalesce("n", F.lit(0)).alias("n"))).alias("counts"))
    return counted.mapInArrow(tidy(choose), "item_id long, width int, seed long, n_words long")


def passages(docs: DataFrame, seeds: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(key, first_word, passage, seeds) around every seed in the whole texts of (key, text).

    ``seeds`` has for each width sorted hashes and how many words around each are kept. Passages that touch are one.
    """
    small_batches(docs.sparkSession)

    def compute(batches):
        filters = [filtered(own) for own, _ in seeds]
        for batch in batches:
            keys, firsts, texts, found = [], [], [], []
            column, key = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for base, encoded in shingles.chunks(column):
                encoded = [plain(e) for e in encoded]
                h, bounds, starts, ends = shingles.word_hashes(encoded)
                spots = []
                for width, ((own, reach), seen) in enumerate(zip(seeds, filters), 1):
                    if len(own) and len(h) >= width:
                        at, place = known(shingles.rolling(h, width), own, seen)
                        owner = np.searchsorted(bounds, at, "right") - 1
                        inside = at + width <= bounds[owner + 1]
                        at, place, owner = at[inside], place[inside], owner[inside]
                        spots.append(np.stack([owner, np.maximum(bounds[owner], at - reach[place]), np.minimum(bounds[owner + 1], at + width + reach[place]), own[place].view(np.int64), np.full(len(at), width)]))
                spots = np.concatenate(spots, axis=1) if spots else np.empty((5, 0), np.int64)
                if not spots.shape[1]:
                    continue
                spots = spots[:, np.lexsort((spots[1], spots[0]))]
                last = np.maximum.accumulate(spots[2])          # texts follow each other, so places grow with them
                new = np.r_[True, (spots[0][1:] != spots[0][:-1]) | (spots[1][1:] > last[:-1])]
                cuts = np.r_[np.flatnonzero(new), spots.shape[1]]
                offsets = np.cumsum([0, *(len(e) + 1 for e in encoded)])
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    d, a, b = int(spots[0, x]), int(spots[1, x]), int(last[y - 1])
                    keys.append(key[base + d])
                    firsts.append(a - int(bounds[d]))
                    texts.append(encoded[d][starts[a] - offsets[d]:ends[b - 1] - offsets[d]].decode())
                    found.append([{"width": w, "seed": v} for v, w in sorted(set(zip(spots[3, x:y].tolist(), spots[4, x:y].tolist())))])
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string()),
                                   pa.array(found, pa.list_(pa.struct([("width", pa.int32()), ("seed", pa.int64())])))], names=["key", "first_word", "passage", "seeds"])

    return docs.select("key", "text").mapInArrow(tidy(compute), "key long, first_word long, passage string, seeds array<struct<width:int,seed:long>>")


def scored(pairs: DataFrame) -> DataFrame:
    """(key, item_id, score, first_word, last_word) of rows (key, first_word, passage, item_id, text)."""

    def compute(batches):
        for batch in batches:
            out = []
            for key, first, passage, item, text in zip(*(c.to_pylist() for c in batch.columns)):
                share, a, b = align(words(text), words(passage))
                out.append((key, item, share, first + a, first + b - 1))
            cols = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["key", "item_id", "score", "first_word", "last_word"])

    return pairs.select("key", "first_word", "passage", "item_id", "text").mapInArrow(
        compute, "key long, item_id long, score double, first_word long, last_word long")


def within_reach(pairs: DataFrame, least: float) -> DataFrame:
    """The rows of ``pairs`` (as ``scored`` takes them) whose score may be ``least`` or more."""
    pairs = pairs.select("key", "first_word", "passage", "item_id", "text")

    def compute(batches):
        for batch in batches:
            split: dict[str, list[str]] = {}
            got = [split.get(t) or split.setdefault(t, words(t)) for c in (2, 4) for t in batch.column(c).to_pylist()]
            yield batch.filter(pa.array([ceiling(i, p) >= least for p, i in zip(got[:len(batch)], got[len(batch):])], pa.bool_()))

    return pairs.mapInArrow(tidy(compute), pairs.schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(key, item_id, score, first_word, last_word) of texts (key, text) holding at least the share ``least`` of a test item.

    The best passage for each key and item, in words of the text from 0. Null and empty texts hold nothing; items without id
    or words are left out, repeated items count once, items of one id stand for the best of their texts. Equal keys are one text's rows.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct()
    small_batches(spark)
    all_seeds = store(seeds_of(items, docs, least))
    seeds = store(all_seeds.groupBy("width", "seed").agg((MATCH * F.max("n_words")).alias("reach")))
    passes = -(-seeds.count() // MAX_SEEDS)
    if not passes:
        return spark.createDataFrame([], "key long, item_id long, score double, first_word long, last_word long")
    out = None
    for k in range(passes):
        mine = F.pmod("seed", F.lit(passes)) == k
        got = leaks_of_seeds(docs, items, all_seeds.where(mine), seeds.where(mine), least)
        out = got if out is None else out.union(got)
    best = out.where(F.col("score") >= least).groupBy("key", "item_id").agg(
        F.max(F.struct("score", (-F.col("first_word")).alias("f"), "last_word")).alias("best"))
    return best.select("key", "item_id", F.col("best.score").alias("score"), (-F.col("best.f")).alias("first_word"), F.col("best.last_word").alias("last_word"))


def leaks_of_seeds(docs: DataFrame, items: DataFrame, part: DataFrame, seeds: DataFrame, least: float) -> DataFrame:
    rows = seeds.toArrow()                          # MAX_SEEDS of them, about
    width, seed, reach = (rows.column(c).to_numpy() for c in ("width", "seed", "reach"))
    own = []
    for k in range(1, SEED_WORDS + 1):
        hashes = seed[width == k].view(np.uint64)
        order = np.argsort(hashes)
        own.append((hashes[order], reach[width == k][order]))
    near = store(passages(docs, own).withColumn("pid", F.xxhash64("key", "first_word", "passage")))
    held = part.select("width", "seed", "item_id").distinct()
    asked = near.select("pid", F.inline("seeds")).join(small_side(held), ["width", "seed"]).select("pid", "item_id").distinct()
    pairs = asked.join(near.select("pid", "key", "first_word", "passage").dropDuplicates(["pid"]), "pid").join(small_side(items), "item_id")
    return scored(within_reach(pairs, least).repartition(F.xxhash64("key", "first_word", "item_id")))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that hold no test item, with all columns."""
    key = F.xxhash64("doc_id", "text")
    leaks = store(find_leaks(docs.select(key.alias("key"), "text"), benchmark).select(F.col("key").alias("_key")).distinct())
    rows = shielded(docs, "doc_id", "text")
    return rows.withColumn("_key", key).join(small_side(leaks), "_key", "left_anti").select(*rows.columns).toDF(*docs.columns)


@query()
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a test item, with the item, score and words; null and empty texts hold none, rows of equal id are one document's."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).withColumnRenamed("key", "doc_id")
