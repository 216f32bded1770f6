"""MinHash near-dedup with tensored banding.

``HALVES`` small collections of ``ROWS`` minhashes each are computed, and every pair of collections is a table key: 42 minhashes
serve 91 tables of 6. Texts that share a key are candidates. Candidates are grouped, and inside a group full
shingle sets decide exactly. Texts of equal sets stand as one class throughout, so exact copies cost one row.

At a similarity of 0.8 a collection agrees with odds 0.512, so a pair shares no table with odds 0.0007; two texts at 0.05, with odds 1.4e-6.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions.sizing import small_side, store
from driftline.llm import shingles
from driftline.llm.components import components
from driftline.llm.registry import query, shielded, small_batches, table, tidy

HALVES, ROWS = 14, 3
BLOCK_TEXTS, BLOCK_SHINGLES = 1_500, 2_000_000      # most that meet in one task of a group, hubs apart
SETS_AT_ONCE = 500                                  # full sets of so many texts are in memory together
HUBS = 16                                           # texts of a large group that all of its blocks see
_RNG = np.random.default_rng(20240607)
XORS = _RNG.integers(0, 1 << 63, HALVES * ROWS, dtype=np.uint64)
ODDS = _RNG.integers(0, 1 << 63, HALVES * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def half_keys(values: np.ndarray) -> np.ndarray:
    """One hash per collection of minhashes of a shingle set."""
    least = np.full(HALVES * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 8192):
        least = np.minimum(least, ((values[at:at + 8192, None] ^ XORS) * ODDS).min(axis=0))
    least = shingles.mixed(least).reshape(HALVES, ROWS)
    out = least[:, 0]
    for k in range(1, ROWS):
        out = shingles.mixed(out * np.uint64(shingles.BASE) + least[:, k])
    return out.view(np.int64)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, halves) of every row of (doc_id, text); an empty set has no set_id and no halves."""
    small_batches(docs.sparkSession)

    def compute(batches):
        for batch in batches:
            n, ids, halves = [], [], []
            for s in shingles.sets(batch.column(1).to_pylist(), width):
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                halves.append(half_keys(s) if len(s) else None)
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(halves, pa.list_(pa.int64()))],
                                  names=["doc_id", "n_shingles", "set_id", "halves"])

    return docs.select("doc_id", "text").mapInArrow(tidy(compute), "doc_id long, n_shingles long, set_id binary, halves array<long>")


def candidate_links(classes: DataFrame) -> DataFrame:
    """(a, b): each class of (rep, halves) linked to the first class with the same table key.

    Keys are range-sorted together with the class, so a key that very many classes share lies in several partitions; each of them links to
    its own first class, and these first classes are linked with one another.
    """
    spark = classes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = F.array(*[F.xxhash64(F.lit(i), F.lit(j), F.col("halves")[i], F.col("halves")[j]) for i, j in combinations(range(HALVES), 2)])
    rows = classes.select("rep", F.explode(keys).alias("key")).repartitionByRange(parts, "key", "rep").sortWithinPartitions("key", "rep")

    def star(batches):
        head_key = head = None
        edge, last = [], None
        seen: set = set()
        for batch in batches:
            rep, key = (batch.column(k).to_numpy() for k in (0, 1))
            if not len(rep):
                continue
            new = np.concatenate([[head_key is None or key[0] != head_key], key[1:] != key[:-1]])
            group = np.cumsum(new) - 1
            heads = rep[new] if new[0] else np.concatenate([[head], rep[new]])
            first = heads[group if new[0] else group + 1]
            if head_key is None:
                edge.append((int(key[0]), int(rep[0])))
            head_key, head = key[-1], first[-1]
            last = (int(head_key), int(head))
            differ = first != rep
            pairs = np.unique(np.stack([first[differ], rep[differ]], axis=1), axis=0)
            yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], names=["a", "b", "key"])
        seen.update(edge + ([last] if last else []))
        if seen:
            keys_, firsts = zip(*sorted(seen))
            yield pa.record_batch([pa.array(firsts, pa.int64()), pa.array(firsts, pa.int64()), pa.array(keys_, pa.int64())], names=["a", "b", "key"])

    found = store(rows.mapInArrow(tidy(star), "a long, b long, key long"))
    edges = found.where("key IS NOT NULL")          # two rows per partition at most
    across = edges.join(edges.groupBy("key").agg(F.min("a").alias("first")), "key").where("a <> first").select(F.col("first").alias("a"), "b")
    return found.where("key IS NULL").select("a", "b").union(across).distinct()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def roots_of(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The group of each set under links of at least ``percent``, exact, as the number of the group's first set.

    Sets are held against a few of their number first, which settles groups of near copies; only sets outside the
    largest group are then counted against all through the shingles they share.
    """
    root = np.arange(len(sets))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    def join(x: int, y: int) -> None:
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)

    hubs: list[int] = []
    for i, s in enumerate(sets):
        near = [h for h in hubs if linked(s, sets[h], percent)]
        for h in near:
            join(i, h)
        if not near and len(hubs) < HUBS:
            hubs.append(i)
    group = np.array([find(i) for i in range(len(sets))])
    if len(sets) <= HUBS and len(hubs) == len(sets):        # each was held against all before it
        return group
    names, counts = np.unique(group, return_counts=True)
    rest = np.flatnonzero(group != names[counts.argmax()])
    if not len(rest):
        return group
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    for i in rest:
        a, b = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        n = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero(100 * both >= percent * (sizes + sizes[i] - both)):
            join(int(i), int(j))
    return np.array([find(i) for i in range(len(sets))])


def confirmed(members: DataFrame, percent: int) -> DataFrame:
    """(rep, root) inside each group of (grp, rep, shingles): the classes linked by full sets. A group is held in one task."""

    def work(batches):
        now, reps, held = None, [], []

        def done():
            order = np.argsort(reps, kind="stable")
            ids = np.array(reps)[order]
            keep = np.concatenate([[True], ids[1:] != ids[:-1]])
            got = roots_of([held[k] for k in order[keep]], percent)
            return pa.record_batch([pa.array(ids[keep]), pa.array(ids[keep][got])], names=["rep", "root"])

        for batch in batches:
            for grp, rep, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if grp != now and reps:
                    yield done()
                    reps, held = [], []
                now = grp
                reps.append(rep)
                held.append(np.frombuffer(s.as_buffer(), np.uint64))
        if reps:
            yield done()

    grouped = members.select("grp", "rep", "shingles").repartition("grp").sortWithinPartitions("grp")
    return grouped.mapInArrow(tidy(work), "rep long, root long")


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of (doc_id, text): groups of texts linked by shared shingles.

    Two texts are linked if 100 * shared shingles >= percent * all their shingles; a group is what links reach, named by its
    smallest doc_id, and the row with that id is kept. Texts without words link with nothing. Rows of null id are in no
    group and are kept. Repeated rows are each returned; an id that stands for several texts joins their groups. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    sketches = store(sketch(docs, width))
    usable = sketches.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    classes = store(usable.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves")))
    groups = components(candidate_links(classes))
    sized = classes.select("rep", "set_id", "n").join(groups.withColumnRenamed("id", "rep"), "rep")
    # Sizes by an aggregate, so that a large group is no window; its texts are dealt over blocks.
    sizes = sized.groupBy("component").agg(F.count("*").alias("texts"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("total") / BLOCK_SHINGLES))
    sized = store(sized.join(sizes.where("texts > 1").select("component", blocks.alias("blocks")), "component")
                  .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "rep"), F.col("blocks"))))

    # Texts of candidates only, with their full sets.
    wanted = small_side(sized.select(F.col("rep").alias("doc_id"), F.col("set_id").alias("wanted"), "component", "blocks", "block"))

    def full(batches):
        for batch in batches:
            for at in range(0, len(batch), SETS_AT_ONCE):
                part = batch.slice(at, SETS_AT_ONCE)
                got = list(shingles.sets(part.column(1).to_pylist(), width))
                keep = [i for i, (s, w) in enumerate(zip(got, part.column(2).to_pylist())) if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == w]
                part = part.take(pa.array(keep, pa.int64()))
                yield pa.record_batch([part.column(0), *(part.column(k) for k in (3, 4, 5)), pa.array([got[i].tobytes() for i in keep], pa.binary())],
                                      names=["rep", "component", "blocks", "block", "shingles"])

    chosen = docs.join(wanted, "doc_id").select("doc_id", "text", "wanted", "component", "blocks", "block")
    members = store(chosen.mapInArrow(tidy(full), "rep long, component long, blocks long, block long, shingles binary"))

    in_blocks = members.select(F.concat_ws(":", "component", "block").alias("grp"), "rep", "shingles")
    split = members.where("blocks > 1")
    links = None
    if not split.isEmpty():
        # Some texts of a large group, the same for each run, are seen by all of its blocks.
        ordered = Window.partitionBy("component").orderBy(F.xxhash64(F.lit("hub"), "rep"), "rep")
        hubs = split.select("component", "rep", "blocks").withColumn("k", F.row_number().over(ordered)).where(F.col("k") <= HUBS).select("component", "rep", "blocks")
        hubs = hubs.join(split.select("rep", "shingles"), "rep").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        in_blocks = in_blocks.union(hubs.select(F.concat_ws(":", "component", "block"), "rep", "shingles"))
        links = store(confirmed(in_blocks, percent))
        links = links.union(across_blocks(split, links, percent))
    else:
        links = confirmed(in_blocks, percent)
    final = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))

    named = classes.select("set_id", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_id", F.coalesce("component", "rep").alias("component_id"))
    out = sketches.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def across_blocks(split: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links between blocks of large groups that are not one group yet: what is outside a group's main part meets every block.

    Two texts of the main part are linked already, so all pairs that matter are compared. The texts outside come in chunks.
    """
    labels = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "label")
    labelled = store(split.select("component", "blocks", "block", "rep", F.length("shingles").alias("bytes"))
                     .join(labels.withColumnRenamed("id", "rep"), "rep"))
    counts = labelled.groupBy("component", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("component").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    outside = labelled.join(main, "component").where("label <> main")
    sizes = outside.groupBy("component").agg(F.ceil(F.sum("bytes") / (8 * BLOCK_SHINGLES)).alias("chunks"))
    outside = outside.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "rep"), F.col("chunks")))
    met = outside.select("component", "rep", "blocks", "chunk").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    inside = split.select("component", "rep", "block").join(sizes, "component").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    name = F.concat_ws(":", "component", "block", "chunk").alias("grp")
    asked = inside.select(name, "rep").union(met.select(name, "rep"))
    return confirmed(asked.join(split.select("rep", "shingles"), "rep"), percent)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less near copies, with all columns: of every group of ``near_groups`` the text of smallest id stays, once.

    A text is known by its id and itself, so unlike texts of one id are all kept, and of rows of equal id and text one stays. Null
    and empty texts are like none but themselves; rows of null id are kept. What goes is less than what stays, so texts meet that, and move only if it is too much to broadcast.
    """
    rows = shielded(docs, "doc_id", "text").withColumn("_key", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = near_groups(rows.select(F.col("_key").alias("doc_id"), "text")).where("doc_id IS NOT NULL")
    texts = store(found.groupBy(F.col("doc_id").alias("_key")).agg(F.min("component_id").alias("component"), F.count("*").alias("rows")))
    ids = rows.where("_key IS NOT NULL").groupBy("_key").agg(F.min("doc_id").alias("id"))
    first = texts.join(ids, "_key").groupBy("component").agg(F.min(F.struct("id", "_key")).alias("first"), F.count("*").alias("n")).where("n > 1")
    stays = small_side(store(first.select("component", F.col("first._key").alias("_stays"))))       # so that a large group's texts do not meet in one task
    gone = store(texts.join(stays, "component").where("_key <> _stays").select("_key"))
    again = texts.where("rows > 1").select("_key").join(gone, "_key", "left_anti")
    once = rows.join(small_side(store(gone.union(again))), "_key", "left_anti")
    repeated = rows.join(small_side(again), "_key", "left_semi").dropDuplicates(["_key"])
    kept = [c for c in rows.columns if c != "_key"]
    return once.select(*kept).union(repeated.select(*kept)).toDF(*docs.columns)


@query()
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies by word pairs; null and empty texts are in no group, equal rows in one."""
    return near_groups(table(spark, sf_dir, "documents"), width=2, percent=80)
