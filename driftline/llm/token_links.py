"""Two tokenizers aligned: which tokens of the one cover the same bytes as which of the other, and how often over a corpus.

Equal texts are one: rows are shuffled by their full text, each distinct text is tokenised and aligned once, and what it adds to the
counts is weighted by its copies. Where tokens of both end at the same byte a group ends; every token of one side is linked with every token
of the other side in its group. The measures of a distinct text then go back to its rows by the text's SHA-256.

A pair's count is the number of rows (documents) that hold it linked. Counts are looked up in two ways: pairs with at least a 2**-18 part of all
countings, which are 2**18 at most, are sent to the tasks; the rest are joined, and none of them is a hot key.

Within a text the work is done once per distinct part: neither tokenizer joins a blank to what stands before it, so a text without
a blank beside other white space parts before each blank. For the second tokenizer its vocabulary is searched for pieces that would
say otherwise; other texts are one part. Tests compare with whole texts.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.sizing import store
from driftline.llm.registry import only, query, ready, slices, table
from driftline.llm.token_files import BLANKS, byte_letters

BATCH_BYTES = 1 << 20           # of text that is handled at a time
FREQUENT = 1 << 18              # a pair is frequent with at least this part of all countings
KNOWN_BYTES = 32 << 20          # of parts and what became of them, per worker; beyond it those met least are dropped
JOINED = 1 << 16                # letters of parts that go to the first tokenizer at a time
LARGE = 4096                    # a group with more links is counted by distinct ids
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
COLUMNS = [T.StructField("key", T.BinaryType()), T.StructField("times", T.LongType()), *(T.StructField(c, T.LongType()) for c in MEASURES),
           T.StructField("groups", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("links", T.ArrayType(T.LongType()))]


def runs_from(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places starts[0], starts[0] + 1, ... (sizes[0] of them), then those of the next run, and so on."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Aligner:
    """What becomes of texts under both tokenizers. Parts met before are kept within a bound."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs a task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True                 # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {c: bytes([b]) for b, c in byte_letters().items()}
        vocabulary = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.bytes_a = [b""] * (vocabulary[-1][1] + 1)
        for piece, i in vocabulary:
            self.bytes_a[i] = b"".join(letters.get(c, c.encode()) for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes.fromhex(m[1]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.parted = not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.blank_a = np.array([x[:1] == b" " for x in self.bytes_a])
        self.text_a, self.text_b = ([str(i).encode() for i in range(len(y))] for y in (self.bytes_a, self.bytes_b))
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[bytes | None] = []                # None: a tokenizer changed the part's bytes
        self.measures = np.empty((4, 0), np.int64)
        self.pair_end, self.pairs, self.links = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.used, self.weight = np.empty(0, np.int64), np.empty(0, np.int64)       # of each part: occurrences, and bytes it takes

    def forget(self) -> None:
        """Keep the parts met most, up to half the bound."""
        order = np.argsort(-self.used, kind="stable")
        keep = np.sort(order[:int(np.searchsorted(np.cumsum(self.weight[order]), KNOWN_BYTES // 2))])
        parts, groups = list(self.index), self.groups
        sizes = (self.pair_end[1:] - self.pair_end[:-1])[keep]
        at = runs_from(sizes, self.pair_end[keep])
        self.index = {parts[k]: i for i, k in enumerate(keep.tolist())}
        self.groups = [groups[k] for k in keep.tolist()]
        self.measures, self.weight, self.used = self.measures[:, keep], self.weight[keep], self.used[keep] // 2
        self.pair_end, self.pairs, self.links = np.r_[0, np.cumsum(sizes)], self.pairs[at], self.links[at]

    def ids_a(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each part has, and all ids. Parts that begin with their only blank are encoded joined: a token with a blank begins the next one."""
        single = [k for k, p in enumerate(parts) if p.rfind(" ") == 0 and not p[-1].isspace()]
        order, counts, flat = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        rest = sorted(set(range(len(parts))).difference(single))
        todo = [single[at:at + 4096] for at in range(0, len(single), 4096)]
        while todo:
            own = todo.pop()
            text = "".join([parts[k] for k in own])
            if len(text) > JOINED and len(own) > 1:
                todo += [own[:len(own) // 2], own[len(own) // 2:]]
                continue
            ids = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            begins = np.flatnonzero(self.blank_a[ids])
            if len(begins) == len(own) and begins[0] == 0:
                order += own
                counts.append(np.diff(np.r_[begins, len(ids)]))
                flat.append(ids)
            else:
                rest += own
        for k, e in zip(rest, self.a.encode_batch_fast([parts[k] for k in rest], add_special_tokens=False) if rest else ()):
            order.append(k)
            counts.append(np.array([len(e.ids)]))
            flat.append(np.array(e.ids, np.int64))
        n, ids = np.concatenate(counts), np.concatenate(flat)
        place = np.argsort(np.array(order, np.int64))
        return n[place], ids[runs_from(n[place], (np.cumsum(n) - n)[place])]

    def learn(self, parts: list[str]) -> None:
        """Tokenise and align new parts, each of which begins with a blank."""
        raw = [p.encode() for p in parts]
        sizes = np.array([len(r) for r in raw], np.int64)
        ids_b = self.b.encode([p[1:] for p in parts], num_threads=1)
        n_b = np.fromiter(map(len, ids_b), np.int64, len(parts))
        good = np.ones(len(parts), bool)
        sides = [self.ids_a(parts), (n_b, np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum())))]
        for (n, flat), pieces, size in zip(sides, (self.bytes_a, self.bytes_b), (self.size_a, self.size_b)):
            ends = np.cumsum(n)
            length = np.r_[0, np.cumsum(size[flat])]
            good &= length[ends] - length[ends - n] == sizes
            if b"".join([pieces[i] for i in flat.tolist()]) != b"".join(raw):
                ids = flat.tolist()
                good &= [b"".join([pieces[i] for i in ids[e - k:e]]) == r for e, k, r in zip(ends.tolist(), n.tolist(), raw)]
        (n_a, a), (n_b, b) = ((np.where(good, n, 0), flat[np.repeat(good, n)]) for n, flat in sides)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        part = np.searchsorted(np.cumsum(np.where(good, sizes, 0)), ends)      # the part a group lies in
        n_groups = np.bincount(part, minlength=len(parts))
        n_links = np.bincount(part, in_a * in_b, minlength=len(parts)).astype(np.int64)
        first_b = np.cumsum(in_b) - in_b
        large = in_a * in_b > LARGE
        times = np.where(large, 0, in_b)[group_a]
        at_b = runs_from(times, first_b[group_a])
        code, owner, weight = (np.repeat(a, times) << 32) | b[at_b], np.repeat(part[group_a], times), np.ones(int(times.sum()), np.int64)
        first_a = np.cumsum(in_a) - in_a
        for g in np.flatnonzero(large).tolist():
            x, nx = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            y, ny = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            code = np.concatenate([code, ((x[:, None] << 32) | y).ravel()])
            weight = np.concatenate([weight, (nx[:, None] * ny).ravel()])
            owner = np.concatenate([owner, np.full(len(x) * len(y), part[g])])
        owner, code, weight = summed(owner, code, weight)
        # Tokens of both sides in the order of the written groups, each with the sign that follows it.
        group = np.concatenate([group_a, group_b])
        order = np.argsort(2 * group + np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)], kind="stable")
        texts = [self.text_a[i] for i in a.tolist()] + [self.text_b[i] for i in b.tolist()]
        group, is_b = group[order], order >= len(a)
        last = np.r_[group[1:] != group[:-1], True][:len(order)]
        sign = np.where(last, 2, np.where(is_b, 0, np.r_[is_b[1:], False][:len(order)].astype(int)))
        signs = (b",", b"|", b";")
        written = [texts[k] + signs[s] for k, s in zip(order.tolist(), sign.tolist())]
        cuts = np.cumsum(n_a + n_b).tolist()
        start = 0
        for p, ok, to in zip(parts, good.tolist(), cuts):
            self.index[p] = len(self.groups)
            self.groups.append(b"".join(written[start:to])[:-1] if ok else None)
            start = to
        self.used = np.r_[self.used, np.zeros(len(parts), np.int64)]
        self.weight = np.r_[self.weight, 2 * sizes + 20 * (n_a + n_b) + 200]
        self.measures = np.concatenate([self.measures, np.stack([n_a, n_b, n_groups, n_links])], axis=1)
        self.pair_end = np.concatenate([self.pair_end, self.pair_end[-1] + np.cumsum(np.bincount(owner, minlength=len(parts)))])
        self.pairs, self.links = np.concatenate([self.pairs, code]), np.concatenate([self.links, weight])

    def align(self, texts: list[str]):
        """Of each text, none of them empty: the four measures, the written groups (None if bytes differ), and its pairs with their links."""
        split, new = [], {}
        for text in texts:
            text = " " + text
            if self.parted and text[-1] != " " and "\0" not in text and not BLANKS.search(text):
                parts = text.replace(" ", "\0 ").split("\0")[1:]
            else:
                parts = [text]
            split.append(parts)
            new.update(dict.fromkeys(parts))
        if new := [p for p in new if p not in self.index]:
            self.learn(new)
        counts = np.array([len(p) for p in split], np.int64)
        flat = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self.used += np.bincount(flat, minlength=len(self.used))
        owner = np.repeat(np.arange(len(texts)), counts)
        groups, start = [], 0
        for n in counts.tolist():
            own = [self.groups[k] for k in flat[start:start + n].tolist()]
            groups.append(None if None in own else b";".join(own))
            start += n
        good = np.array([g is not None for g in groups])
        ends = np.cumsum(counts)
        sums = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(self.measures[:, flat], axis=1)], axis=1)
        measures = (sums[:, ends] - sums[:, ends - counts]) * good
        keep = good[owner]
        key, times = np.unique(owner[keep] * len(self.groups) + flat[keep], return_counts=True)
        part = key % max(1, len(self.groups))
        sizes = self.pair_end[part + 1] - self.pair_end[part]
        at = runs_from(sizes, self.pair_end[part])
        owner, code, links = summed(np.repeat(key // max(1, len(self.groups)), sizes), self.pairs[at], self.links[at] * np.repeat(times, sizes))
        if self.weight.sum() > KNOWN_BYTES:
            self.forget()
        return measures, groups, np.bincount(owner, minlength=len(texts)), code, links


def summed(owner: np.ndarray, code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights added up per owner and code, in this order."""
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])][:len(owner)])
    return owner[first], code[first], np.add.reduceat(weight[order], first) if len(first) else weight[:0]


def aligner(path_a: str, path_b: str) -> Aligner:
    return only(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))


def lists(sizes: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(c, pa.int64())) for c in columns]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per distinct text that is neither null nor empty: key (SHA-256), times (rows that hold it), n_a, n_b, n_groups,
    n_links, groups (``a1,a2|b1;a3|b2``: ids of either side, group after group), pairs (a << 32 | b, each once) and their links.

    A text whose bytes either tokenizer does not give back has no tokens: groups is null, the measures are 0.
    """
    ready(docs.sparkSession)
    distinct = docs.where("text IS NOT NULL AND text != ''").groupBy("text").agg(F.count("*").alias("times"))
    names = [f.name for f in COLUMNS]

    def tag(batches):
        import hashlib

        tool = aligner(path_a, path_b)
        for batch in batches:
            for part in slices(batch, 0, BATCH_BYTES):
                texts = part.column(0).to_pylist()
                measures, groups, sizes, pairs, links = tool.align(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()), part.column(1), *(pa.array(m) for m in measures),
                    pa.array(groups, pa.binary()).cast(pa.string()), *lists(sizes, pairs, links)], names=names)
        tool.clear()

    return distinct.mapInArrow(tag, T.StructType(COLUMNS))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best) from (times, pairs): rows that hold the pair, and whether no pair with its first id has more."""
    def add(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            pairs = batch.column(1)
            sizes = np.diff(np.asarray(pairs.offsets))
            held.append((pairs.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), sizes)))
            n += len(held[-1][0])
            if n > 4_000_000:
                held = [merged(held)]
                n = len(held[0][0])
                if n > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["pair", "n"])
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], names=["pair", "n"])

    counts = store(texts.select("times", "pairs").mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    # One row for each id of the first vocabulary at most.
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(best), F.shiftright("pair", 32) == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, n = (np.concatenate(x) for x in zip(*held))
    _, pairs, n = summed(np.zeros(len(pairs), np.int8), pairs, n)
    return pairs, n


def looked_up(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, n_best, count_sum) from (key, pairs, links): links that are best, and counts added up over links."""
    spark = texts.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most FREQUENT pairs have so large a part of the total.
    rows = counts.where(F.col("n") * FREQUENT >= total).orderBy("pair").toArrow()
    known = spark.sparkContext.broadcast(tuple(rows.column(c).to_numpy() for c in ("pair", "n", "best")))
    schema = "key binary, n_best long, count_sum long, pairs array<bigint>, links array<bigint>"

    def add(batches):
        pair, n, best = known.value
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column(1).offsets))
            pairs, links = (batch.column(k).flatten().to_numpy() for k in (1, 2))
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, pairs), max(0, len(pair) - 1))
            hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            sums = []
            for value in (best, n):
                x = np.concatenate([[0], np.cumsum(np.where(hit, links * value[at], 0) if len(pair) else np.zeros(len(pairs), np.int64))])
                ends = np.cumsum(sizes)
                sums.append(x[ends] - x[ends - sizes])
            rest = lists(np.bincount(owner[~hit], minlength=batch.num_rows), pairs[~hit], links[~hit])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(s, pa.int64()) for s in sums), *rest], names=["key", "n_best", "count_sum", "pairs", "links"])

    first = store(texts.select("key", "pairs", "links").mapInArrow(add, schema))
    rare = first.select("key", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("key", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    rare = rare.join(counts, "pair").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("rare_best"), F.sum(F.col("links") * F.col("n")).alias("rare_sum"))
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return first.select("key", "n_best", "count_sum").join(rare, "key", "left").select("key", plus("n_best", "rare_best"), plus("count_sum", "rare_sum"))


def with_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, as the module says.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have zeros and ''. Rows of equal id or equal text each have
    their own row, and each counts. Other columns are not read. An empty table gives an empty one. Runs in part when this is called.
    """
    texts = aligned(docs.select("text"), path_a, path_b)
    texts = store(texts.withColumn("groups", F.coalesce(F.sha2(F.col("groups").cast("binary"), 256), F.lit(""))).withColumnRenamed("groups", "groups_sha256"))
    counts = store(pair_counts(texts))
    found = texts.drop("pairs", "links", "times").join(looked_up(texts, counts), "key")
    rows = docs.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key")).join(found, "key", "left")
    return rows.select("doc_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in (*MEASURES, "n_best", "count_sum")), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


@query()
def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under byte-level pieces and sentence pieces."""
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return with_links(table(spark, sf_dir, "documents"), *paths)
