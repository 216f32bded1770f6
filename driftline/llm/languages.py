"""Language identification by cross-parsing: how few phrases of a language's own text does a text fall into?

A suffix automaton of each language's labelled text accepts every substring of it. A text is cut greedily into
the longest phrases that the automaton accepts; a letter it never saw is a phrase of its own. Phrases times the
logarithm of the reference's length, and a fixed price for each letter the reference does not have, per letter, estimate the cross entropy; the least wins. Texts are read whole, in blocks of
``BLOCK`` letters that each begin a phrase, so that all blocks of a batch advance letter by letter together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.registry import only, query, shielded, small_batches, table, tidy, widened

REFERENCE_CHARS = 20_000        # text a language's automaton is built from
TRAINING_DOCS = 200             # labelled documents per language it may come from
LEAST_CHARS = 40                # shorter texts teach little and are taken last
BLOCK = 1024                    # letters that are parsed in a row
DENSE = 255                     # most frequent letters, whose steps lie in a full table; steps by other letters are searched
BATCH_CHARS = 1 << 20
UNSEEN_BITS = 16                # what a letter costs beside its phrase where a language's text does not have it: its number must be told
UNKNOWN = "und"


def in_fold(doc_id, folds: int, fold: int):
    """Whether the CRC-32 of the id as text falls into a fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def automaton(text: str) -> list[dict[str, int]]:
    """Suffix automaton of ``text``: for each state the next state by letter; state 0 is the start."""
    states: list[dict] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        now = len(states)
        states.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in states[p]:
            states[p][c] = now
            p = link[p]
        if p >= 0:
            q = states[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(states)
                states.append(dict(states[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and states[p].get(c) == q:
                    states[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return states


def plain(text: str) -> str:
    """Lower case, every run of white space one blank."""
    return " ".join(text.lower().split())


class Parser:
    """Counts phrases of many texts at once against every language's automaton.

    The automata lie in one table: entry (state, letter) holds twice the next state's row, plus one where a phrase ends
    before the letter. A letter that ends a phrase starts the next one. Letters beyond the ``DENSE`` most frequent have no column: their steps
    lie in a sorted list, so an alphabet of thousands takes no more room than its text.
    """

    def __init__(self, models: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in models]
        self.bits = np.array([math.log2(len(text) + 1) for _, text in models])
        counts: dict[str, int] = {}
        for _, text in models:
            for c in text:
                counts[c] = counts.get(c, 0) + 1
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        self.code = np.zeros(0x110000, np.int32)                # 0: no reference has it
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = min(len(letters), DENSE) + 1
        self.rare = max(0, len(letters) - DENSE)                # letters without a column
        states = [automaton(text) for _, text in models]
        sizes = [len(s) for s in states]
        bases = np.cumsum([0, *sizes])
        self.starts = [int(b) * self.width for b in bases[:-1]]
        self.table = np.empty((int(bases[-1]), self.width), np.int32)
        # Letters that a language's own text does not have. Marks and digits are of no language.
        self.strange = np.tile(np.array([False, *map(str.isalpha, letters)]), (len(models), 1))
        for k, (_, text) in enumerate(models):
            self.strange[k, self.code[[ord(c) for c in set(text)]]] = False
        self.rare_first = np.empty((len(models), self.rare), np.int64)
        keys, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k, own in enumerate(states):
            base = int(bases[k])
            at = np.repeat(np.arange(len(own)), [len(s) for s in own])
            by = self.code[np.fromiter((ord(c) for s in own for c in s), np.int64, len(at))].astype(np.int64)
            to = np.fromiter((t for s in own for t in s.values()), np.int64, len(at))
            first = np.zeros(len(letters) + 1, np.int64)
            first[by[at == 0]] = to[at == 0]
            again = 2 * (base + first) * self.width + 1         # a phrase ends, its next letter leads on from the start
            again[0] = 2 * base * self.width + 1
            rows = self.table[base:base + len(own)]
            rows[:] = again[:self.width]
            common = by < self.width
            rows[at[common], by[common]] = 2 * (base + to[common]) * self.width
            self.rare_first[k] = again[self.width:]
            keys.append((base + at[~common]) * max(1, self.rare) + by[~common] - self.width)
            values.append(2 * (base + to[~common]) * self.width)
        keys, values = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(keys)
        self.rare_keys, self.rare_values = keys[order], values[order]
        self.table = self.table.ravel()

    def costs(self, texts: list[str]) -> np.ndarray:
        """Cross entropy in bits a letter, one row per text (none of them empty), one column per language."""
        codes = self.code[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        sizes = np.array([len(t) for t in texts])
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        length = np.minimum(BLOCK, sizes[owner] - rank * BLOCK)
        order = np.argsort(-length, kind="stable")              # blocks that go on longest stand first
        owner, length = owner[order], length[order]
        at = (np.cumsum(sizes) - sizes)[owner] + rank[order] * BLOCK
        active = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), "right")
        state = np.repeat(np.array(self.starts, np.int32)[:, None], len(length), axis=1)
        found = np.ones(state.shape, np.int32)
        searched = codes >= self.width
        some, columns = bool(searched.any()), np.where(searched, 0, codes)
        for step, k in enumerate(active):
            place = at[:k] + step
            got = self.table[state[:, :k] + columns[place]]
            if some and len(rare := np.flatnonzero(searched[place])):
                letter = codes[place[rare]] - self.width
                key = (state[:, rare] // self.width).astype(np.int64) * self.rare + letter
                spot = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
                got[:, rare] = np.where(self.rare_keys[spot] == key, self.rare_values[spot], self.rare_first[:, letter])
            found[:, :k] += got & 1
            state[:, :k] = got >> 1
        total = np.stack([np.bincount(owner, row, len(texts)) for row in found], axis=1)
        first = np.cumsum(sizes) - sizes
        strange = np.stack([np.add.reduceat(own[codes].astype(np.int64), first) for own in self.strange], axis=1)
        return (total * self.bits + strange * UNSEEN_BITS) / sizes[:, None]

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text. The score grows from 0.5 with the lead over the second best language."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return langs, scores
        held: list[tuple[int, str]] = []
        n = 0
        for i, text in enumerate(texts):
            if text and any(map(str.isalpha, text)):
                held.append((i, plain(text)))
                n += len(text)
            if held and (n >= BATCH_CHARS or i == len(texts) - 1):
                costs = self.costs([t for _, t in held])
                best = costs.argmin(axis=1)
                low = np.sort(costs, axis=1)[:, :2]
                lead = 1 - 0.5 * low[:, 0] / low[:, -1] if len(self.langs) > 1 else np.ones(len(held))
                for (k, _), b, s in zip(held, best, lead):
                    langs[k], scores[k] = self.langs[b], float(s)
                held, n = [], 0
        return langs, scores


def parser(models: tuple[tuple[str, str], ...]) -> Parser:
    return only(("parser", models), lambda: Parser(models))


def references(labelled: DataFrame, chars: int = REFERENCE_CHARS, docs: int = TRAINING_DOCS) -> tuple[tuple[str, str], ...]:
    """Reference text per language from (doc_id, text, lang): a bounded sample, in hash order, equal texts once.

    At most ``docs`` documents of a language reach the driver, each as a slice of a fiftieth of ``chars`` from somewhere in its text, so that no long
    text speaks for a language; texts of fewer than ``LEAST_CHARS`` letters come after all others. Rows are thinned by hash to a few times what is wanted
    before any are ranked, so a language with most rows is no burden.
    """
    share = max(LEAST_CHARS, chars // 50)
    size = F.length("text")
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", F.xxhash64("doc_id", size).alias("at"), (size < LEAST_CHARS).alias("short"), "text").where(size > 0)
    counts = known.groupBy("lang", "short").agg(F.count("*").alias("n"))
    odds = (4 * docs + 100) / F.col("n") * float(1 << 40)
    thin = known.join(F.broadcast(counts), ["lang", "short"]).where(F.pmod(F.xxhash64(F.lit("thin"), "at"), F.lit(1 << 40)) < odds)
    start = F.pmod(F.xxhash64(F.lit("slice"), "at"), F.greatest(F.lit(1).cast("long"), size - share + 1)).cast("int") + 1
    cut = thin.select("lang", "at", "short", F.substring("text", start, F.lit(share)).alias("text")).where(F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("short", "at", "text"))
    rows = cut.withColumn("rank", rank).where(F.col("rank") <= docs).orderBy("lang", "rank").collect()
    texts: dict[str, dict[str, None]] = {}
    for r in rows:
        texts.setdefault(r["lang"], {})[plain(r["text"])] = None
    return tuple((lang, "\n".join(got)[:chars]) for lang, got in sorted(texts.items()))


def predict(docs: DataFrame, models: tuple[tuple[str, str], ...]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, replacing columns of these names; texts are read whole.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was learnt. Ties go to the first language by name.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")
    schema = widened(docs.schema, lang_pred=T.StringType(), score=T.DoubleType())

    def tag(batches):
        known = parser(models)
        for batch in batches:
            langs, scores = known.judge(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(tidy(tag), schema)


def identify(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """``predict`` with what the labelled rows of ``learn_from`` (by default ``docs``) teach."""
    labelled = docs if learn_from is None else learn_from
    return predict(docs, references(labelled))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with the columns of ``docs``; all rows if no text is labelled to learn from."""
    rows = shielded(docs, "doc_id", "text", "lang")
    models = references(rows)
    if not models:
        return docs
    return predict(rows, models).where(F.col("lang_pred") != UNKNOWN).select(*rows.columns).toDF(*docs.columns)


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's language, learnt from four fifths of the labelled documents; null texts and texts without a letter are ``und``."""
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    found = identify(docs.select("doc_id", "text"), docs.where(~held_out).select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
