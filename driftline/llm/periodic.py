"""Periodic runs: stretches of words that repeat with a period, found through Lyndon roots.

A run is a stretch with smallest period q that no neighbouring word extends. Its root, seen from the right place and under
one of two alphabetical orders, is the longest Lyndon word that starts there (the runs theorem). The first phase of Baier's
suffix sorter groups suffixes by exactly these words: when a group comes up, its common prefix is the longest Lyndon word
at each of its places. So the phase is done once under the order of the words and once under its reverse, and every root
that stands twice in a row is extended to both sides by longest common extensions.

Only regions where runs of the wanted length can lie are sorted: in a run of at least max(``least``, ``times`` q) words every stretch
of ``window`` words occurs again q words away (see ``window_of``), so words outside such repeated stretches belong to no run. Texts are
handled whole; a batch of texts keeps about 300 bytes a word of its regions in memory.
"""

from __future__ import annotations

from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.registry import query, ready, shielded, slices, table, widened

LEAST, TIMES = 24, 3            # a run has at least max(LEAST, TIMES x period) words
BATCH_BYTES = 4 << 20           # of text that is handled at a time
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
WORD_GAPS = r"[\x20\x09-\x0D]+"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def window_of(least: int, times: int) -> int:
    """The longest stretch that must recur q words away wherever it lies in a run: min over q of max(least, times q) - 2q + 1."""
    return max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 1)))


def lyndon_lengths(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place: phase one of Baier's suffix sorter.

    Groups hold suffixes with a common prefix and come up from the greatest to the least. Each suffix of a group points to the
    nearest place before it that no group so far has held; a place with k pointers leaves its group for one just above it, whose prefix is its own followed by k
    times the prefix of the group at hand.
    """
    n = len(codes)
    letters = sorted(set(codes))
    number = {c: g for g, c in enumerate(letters)}
    group = [number[c] for c in codes]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [1] * len(letters)
    lower, upper = list(range(-1, len(letters) - 1)), list(range(1, len(letters) + 1))
    found = [1] * n
    free = list(range(n + 1))               # slot i + 1 leads to the nearest place at or before i that is still open; slot 0 is none
    g = len(letters) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        step = size[g]
        for i in own:
            found[i] = step
            free[i + 1] = i                 # closed
        pointers: dict[int, int] = {}
        for i in own:
            at = i + 1
            while free[at] != at:
                free[at] = free[free[at]]
                at = free[at]
            if at:
                pointers[at - 1] = pointers.get(at - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for place, k in pointers.items():
            moved.setdefault((-k, group[place]), []).append(place)
        for minus, old in sorted(moved):    # most pointers first: each new group goes directly above the old one
            places, new, above = moved[minus, old], len(size), upper[old]
            for place in places:
                group[place] = new
            members.append(places)
            size.append(size[old] - minus * step)
            lower.append(old)
            upper.append(above)
            lower[above], upper[old] = new, new
        members[g] = ()
        g = lower[g]
    return found


def regions(codes: np.ndarray, doc: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Stretches [from, to) of a batch's words, each within a document, that hold all its runs."""
    window = window_of(least, times)
    n = len(codes) - window + 1
    if n < 2:
        return []
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _ODD
    mixed ^= mixed >> np.uint64(29)
    key = doc[:n].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for k in range(window):
        key = (key ^ mixed[k:n + k]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
    at = np.flatnonzero(doc[:n] == doc[window - 1:])        # windows within one document
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    gap = np.diff(order)
    nearest = np.full(n, len(codes), np.int64)
    nearest[order[1:][same]] = gap[same]
    nearest[order[:-1][same]] = np.minimum(nearest[order[:-1][same]], gap[same])
    for _ in range(2):                                      # a region bounds the period, which bounds the distance to the next occurrence
        here = np.flatnonzero(nearest < len(codes))
        if not len(here):
            return []
        cut = np.flatnonzero((np.diff(here) > 1) | (doc[here[1:]] != doc[here[:-1]])) + 1
        first, last = here[np.r_[0, cut]], here[np.r_[cut, len(here)] - 1]
        long = last + window - first
        limit = np.repeat(np.where(long >= least, long // times, 0), np.diff(np.r_[0, cut, len(here)]))
        nearest[here[nearest[here] > limit]] = len(codes)
    keep = long >= least
    return list(zip(first[keep].tolist(), (last + window)[keep].tolist()))


def common(key: np.ndarray, power: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """For pairs of places, how many words agree from them on (or before them, if ``back``), by halving over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high + 1) // 2, low)
        x, y = (a - mid, b - mid) if back else (a, b)
        equal = key[x + mid] - key[x] * power[mid] == key[y + mid] - key[y] * power[mid]
        low, high = np.where(open_ & equal, mid, low), np.where(open_ & ~equal, mid - 1, high)
    return low


def extended(text: np.ndarray, start: int, end: int, i: int, q: int) -> tuple[int, int]:
    """Where the stretch of period ``q`` around place ``i`` starts, and its length."""
    unlike = np.flatnonzero(text[start:end - q] != text[start + q:end]) + start
    at = int(np.searchsorted(unlike, i))
    first = int(unlike[at - 1]) + 1 if at else start
    return first, (int(unlike[at]) if at < len(unlike) else end - q) + q - first


def runs_of(codes: np.ndarray, doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least max(least, times period) words in a batch of documents, by start, then period.

    ``codes`` are words as numbers, ``doc`` each word's document, ascending. ``times`` is at least 3.
    """
    if not (spans := regions(codes, doc, least, times)):
        return []
    sizes = np.array([b - a for a, b in spans])
    base = np.cumsum(sizes + 1) - sizes - 1                 # regions lie one after the other, a letter of its own after each
    text = np.empty(int(sizes.sum()) + len(sizes), np.int64)
    place = np.empty_like(text)
    lengths = [np.ones_like(text), np.ones_like(text)]
    for k, ((a, b), at) in enumerate(zip(spans, base.tolist())):
        end = at + b - a
        text[at:end], text[end], place[at:end + 1] = codes[a:b], -1 - k, np.arange(a, b + 1)
        part = codes[a:b].tolist()
        lengths[0][at:end] = lyndon_lengths(part)
        lengths[1][at:end] = lyndon_lengths([-c for c in part])
    region = np.repeat(np.arange(len(sizes)), sizes + 1)
    start, end = base[region], (base + sizes)[region]
    mixed = (text.astype(np.uint64) + np.uint64(len(sizes) + 1)) * _ODD
    mixed ^= mixed >> np.uint64(31)
    key, power = np.zeros(len(text) + 1, np.uint64), np.ones(len(text) + 1, np.uint64)
    np.cumprod(np.full(len(text), _ODD), out=power[1:])
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))        # prefix hashes by a running sum: hash(i) = base**i * sum of letter * base**-(k + 1)
    back = np.ones(len(text), np.uint64)
    np.cumprod(np.full(len(text), inverse), out=back)
    key[1:] = np.cumsum(mixed * back) * power[1:]
    found: set[tuple[int, int, int]] = set()
    for root in lengths:
        i = np.flatnonzero(np.arange(len(text)) + 2 * root <= end)
        p = root[i]
        again = root[i + p] == p                            # the root stands twice in a row, told by length and hash
        i, p = i[again], p[again]
        twice = key[i + p] - key[i] * power[p] == key[i + 2 * p] - key[i + p] * power[p]
        i, p = i[twice], p[twice]
        square = np.zeros(len(text), bool)
        square[i] = True
        before = np.maximum(i - p, start[i])
        first = (before != i - p) | ~square[before] | (root[before] != p)   # one place speaks for a row of roots
        i, p = i[first], p[first]
        right = common(key, power, i, i + p, end[i] - i - p, False)
        left = common(key, power, i, i + p, i - start[i], True)
        first, length = i - left, left + p + right
        keep = length >= np.maximum(least, times * p)
        for k, s, n, q in zip(i[keep].tolist(), first[keep].tolist(), length[keep].tolist(), p[keep].tolist()):
            if not np.array_equal(text[s:s + n - q], text[s + q:s + n]):    # unlike words share a hash: word by word
                s, n = extended(text, int(start[k]), int(end[k]), k, q)
            if n >= max(least, times * q):
                found.add((int(place[s]), n, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def judged(texts: list[bytes | None], least: int, times: int) -> tuple[list[int], list[list[dict]], list[bytes]]:
    """Number of words, runs, and the words that no run repeats, of each text."""
    words = [t.split() if t else [] for t in texts]         # bytes part at exactly the six ASCII blanks
    sizes = np.array([len(w) for w in words], np.int64)
    known: dict[bytes, int] = {}
    codes = np.fromiter(map(known.setdefault, chain.from_iterable(words), count()), np.int64, int(sizes.sum()))
    offset = (np.cumsum(sizes) - sizes).tolist()
    doc = np.repeat(np.arange(len(texts)), sizes)
    runs: list[list[dict]] = [[] for _ in texts]
    for s, n, q in runs_of(codes, doc, least, times):
        d = int(doc[s])
        runs[d].append({"start": s - offset[d], "length": n, "period": q})
    for got, own in zip(runs, words):
        if got:
            kept = np.ones(len(own), bool)
            for r in got:
                kept[r["start"] + r["period"]:r["start"] + r["length"]] = False
            own[:] = [own[k] for k in np.flatnonzero(kept)]
    return sizes.tolist(), runs, [b" ".join(w) for w in words]


def with_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    ``collapsed`` is the text without what runs repeat: the words that no run holds after its first period, joined by one blank.
    Columns of these names are replaced. Null and empty texts have no words, no runs and an empty ``collapsed``; rows of equal
    id are judged each for itself; an empty table gives an empty one.
    """
    if times < 3:
        raise ValueError("roots are only sought where they stand twice whole: times must be 3 or more")
    ready(docs.sparkSession)
    docs = docs.drop("n_words", "runs", "collapsed")
    rows = shielded(docs, "text").withColumn("_bytes", F.col("text").cast("binary"))
    schema = widened(T.StructType(rows.schema.fields[:-1]), n_words=T.LongType(), runs=RUNS, collapsed=T.StringType())
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def tag(batches):
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, BATCH_BYTES):
                n, runs, kept = judged(part.column(part.num_columns - 1).to_pylist(), least, times)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.mapInArrow(tag, schema).toDF(*docs.columns, "n_words", "runs", "collapsed")


def longest(runs):
    """The run of greatest length over period, compared exactly; the first of equals."""
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    return F.aggregate(runs, F.lit(None).cast(RUNS.elementType), lambda a, b: F.when(better(a, b), b).otherwise(a))


def repeating(docs: DataFrame) -> DataFrame:
    """``docs`` with every tenth text made to repeat from some word on, as its id's checksum says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", WORD_GAPS), lambda w: w != "")
    mine = docs.withColumn("_h", h).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    g, n = F.floor(F.col("_h") / 10), F.size("_words").cast("long")
    mine = mine.withColumn("_n", F.when(n > 0, n)).withColumn("_a", g % F.col("_n"))
    mine = mine.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8)))
    rest = F.col("_n") - F.col("_a")
    unit = F.slice("_words", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("_p")).cast("int"))), F.lit(1), rest.cast("int"))
    made = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a").cast("int")), tail), " ")
    return mine.withColumn("text", F.when(F.col("_n").isNotNull(), made).otherwise(F.col("text"))).select("doc_id", "text")


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs as digests, over texts of which one in ten is made to repeat."""
    found = with_runs(repeating(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = longest(F.col("runs"))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
