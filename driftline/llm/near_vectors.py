"""Embedding near-dedup by collision-counting projections.

Vectors are laid along many random one-dimensional projections. Two vectors collide on a projection if one lies in the window around
the other; pairs that collide on as many projections as nearly all true pairs do are verified by their cosine. Counting every pair
would be quadratic, so a pair is counted only where it shares a cell: a cell is the place of a vector before or after the middle of
each of several sorted projections. Cells are drawn anew for each table until, by the density measured on a
sample, a pair at the threshold shares none with odds of 0.001; where that takes too many tables, cells are made larger. Links are counted where they are found and never listed.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.sizing import small_side, store
from driftline.llm.components import components
from driftline.llm.registry import query, ready, table

COSINE = 0.95
MISS = 0.001            # odds to lose a pair at the threshold, for cells and for the count each
PROJECTIONS = 48        # collisions are counted on
WINDOW = 1.5            # half a window, in standard deviations of the projected difference of a pair at the threshold
CELL = 64               # vectors in a cell on average
MOST_TABLES = 512       # with more, cells are made larger instead
FIRST_TABLES = 16       # show whether that many will do
SAMPLE = 5_000          # vectors the middles and densities are measured on
BLOCK = 1_024           # vectors of a cell that meet in one task


class Index(NamedTuple):
    directions: np.ndarray      # (tables, bits, dim)
    middles: np.ndarray         # (tables, bits)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that neither large nor tiny numbers are lost."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit(sample: np.ndarray, n: int, cosine: float = COSINE, miss: float = MISS, seed: int = 11) -> Index:
    """Cells for ``n`` vectors like those of ``sample`` (rows of length one).

    Where vectors lie so dense that ``MOST_TABLES`` would still lose more pairs than ``miss``, cells are cut by fewer projections, at last by
    none: they are larger then, and each is compared whole in blocks.
    """
    bits = max(0, math.ceil(math.log2(max(1, n) / CELL)))
    while (index := fit_bits(sample, bits, cosine, miss, seed)) is None:
        bits -= 1
    return index


def fit_bits(sample: np.ndarray, bits: int, cosine: float, miss: float, seed: int) -> Index | None:
    """Cells of ``bits`` projections each, or none if ``MOST_TABLES`` would not do."""
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    apart = math.sqrt(2 * (1 - cosine)) * math.sqrt(2 / math.pi)         # mean distance of a pair's projections
    directions, middles, lost = [], [], 1.0
    while lost > miss:
        # Given up early where the tables so far show that the wanted odds are far off.
        if len(directions) == MOST_TABLES or len(directions) == FIRST_TABLES and math.log(lost) * MOST_TABLES / FIRST_TABLES > math.log(miss) / 2:
            return None
        d = rng.normal(size=(bits, dim))
        places = sample @ d.T
        middle = np.median(places, axis=0) if len(sample) else np.zeros(bits)
        density = (np.abs(places - middle) <= 0.15).mean(axis=0) / 0.3 if len(sample) else np.zeros(bits)
        # Middles of pairs lie denser than vectors where these are hardly wider spread than a pair: then the angle between the two counts.
        spread = np.maximum(((places - middle) ** 2).mean(axis=0), 1e-12) if len(sample) else np.ones(bits)
        angle = np.arccos(np.clip(1 - (1 - cosine) / spread, -1, 1)) / np.pi
        lost *= 1 - np.prod(np.clip(1 - np.maximum(apart * density, angle), 0, 1))
        directions.append(d)
        middles.append(middle)
    return Index(np.array(directions).reshape(len(directions), bits, dim), np.array(middles).reshape(len(directions), bits))


def keys_of(index: Index, rows: np.ndarray) -> np.ndarray:
    """The cell of each row in each table."""
    tables, bits, dim = index.directions.shape
    if not bits:
        return np.zeros((len(rows), tables), np.int64)
    side = (rows @ index.directions.reshape(-1, dim).T).reshape(len(rows), tables, bits) > index.middles
    return side @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def least_count(projections: int = PROJECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """The largest number of collisions that a pair at the threshold reaches but with odds ``miss``."""
    p, tail = math.erf(window / math.sqrt(2)), 0.0
    for k in range(projections + 1):
        tail += math.comb(projections, k) * p ** k * (1 - p) ** (projections - k)
        if tail > miss:
            return k
    return 0


def counting(dim: int, seed: int = 12) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim, PROJECTIONS))


def pairs_linked(a: np.ndarray, b: np.ndarray, keys_a: np.ndarray, keys_b: np.ndarray, at: int, cosine: float) -> np.ndarray:
    """Matrix of the links between rows of ``a`` and of ``b`` that no earlier table than ``at`` has shown."""
    along = counting(a.shape[1])
    half = WINDOW * math.sqrt(2 * (1 - cosine))
    pa_, pb = (a @ along).T, (b @ along).T
    hits = np.zeros((len(a), len(b)), np.int16)
    for x, y in zip(pa_, pb):
        hits += np.abs(x[:, None] - y[None, :]) <= half
    i, j = np.nonzero(hits >= least_count())
    out = np.zeros(hits.shape, bool)
    for s in range(0, len(i), 200_000):
        u, v = i[s:s + 200_000], j[s:s + 200_000]
        good = np.einsum("ij,ij->i", a[u], b[v]) >= cosine
        u, v = u[good], v[good]
        first = (keys_a[u] == keys_b[v]).argmax(axis=1) == at
        out[u[first], v[first]] = True
    return out


def found_in(vectors: np.ndarray, keys: np.ndarray, sizes: np.ndarray, block: np.ndarray, same: bool, at: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(vectors linked, number of the smallest row linked) for each row of a block of a cell, or of two, which are then held against each other."""
    n = len(vectors)
    links = np.zeros((n, n), bool)
    if same:
        links = pairs_linked(vectors, vectors, keys, keys, at, cosine)
        np.fill_diagonal(links, False)
    else:
        cut = int((block == block[0]).sum())
        links[:cut, cut:] = pairs_linked(vectors[:cut], vectors[cut:], keys[:cut], keys[cut:], at, cosine)
        links[cut:, :cut] = links[:cut, cut:].T
    root = np.arange(n)
    while True:
        near = np.where(links, root[None, :], n).min(axis=1)
        new = np.minimum(root, near)
        if (new == root).all():
            return links @ sizes, root
        root = new


def matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def link_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding): vectors linked by a cosine of at least ``cosine``.

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing; vectors of different length neither. Rows of
    equal vectors are a class that costs one row and link with one another; repeated rows are returned each and count. An id that
    stands for several vectors joins their groups. Rows of null id link with nothing, are in no group and are kept. Other columns are not read.
    """
    spark = vectors.sparkSession
    ready(spark)
    e = F.col("embedding")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size(e) > 0) & ~odd & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", F.when(usable, e).alias("embedding"))
    classes = store(rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")))

    # A row per length of vectors, and a bounded sample of each.
    counts = {r["dim"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).collect()}
    indexes = {}
    for dim, n in sorted(counts.items()):
        some = classes.where(F.size("embedding") == dim).orderBy(F.xxhash64("rep")).limit(SAMPLE).select("embedding").collect()
        indexes[dim] = fit(unit(np.array([r["embedding"] for r in some])), n, cosine)

    def place(batches):
        for batch in batches:
            dims = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                keys = keys_of(indexes[int(dim)], unit(matrix(part.column(2))))
                yield pa.record_batch([part.column(0), part.column(1), part.column(2), pa.array(np.full(len(part), dim, np.int32)), pa.array(list(keys), pa.list_(pa.int64()))],
                                      names=["rep", "size", "embedding", "dim", "keys"])

    kind = classes.schema["embedding"].dataType.simpleString()
    placed = store(classes.select("rep", "size", "embedding").mapInArrow(place, f"rep long, size long, embedding {kind}, dim int, keys array<long>"))
    cell = ["dim", "at", "cell"]
    cells = placed.select("rep", "dim", F.posexplode("keys").alias("at", "cell"))
    many = F.ceil(F.col("n") / BLOCK)
    large = small_side(store(cells.groupBy(*cell).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select(*cell, many.alias("blocks"))))
    dealt = placed.select("*", F.posexplode("keys").alias("at", "cell")).join(large, cell, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    # Every two blocks of a cell meet once, each with itself too.
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "rep"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    group = F.xxhash64(*cell, F.least("block", "other"), F.greatest("block", "other"))
    dealt = dealt.select(group.alias("grp"), "at", (F.col("block") == F.col("other")).alias("same"), "block", "rep", "size", "keys", "embedding").repartition("grp").sortWithinPartitions("grp", "block", "rep")

    def count(batches):
        held: list[pa.RecordBatch] = []
        now = None

        def done():
            part = pa.Table.from_batches(held).combine_chunks()
            if len(part) < 2:
                return None
            cols = {n: part.column(n).chunk(0) if part.column(n).num_chunks else part.column(n) for n in part.column_names}
            reps, block = cols["rep"].to_numpy(), cols["block"].to_numpy()
            n, root = found_in(unit(matrix(cols["embedding"])), matrix(cols["keys"]), cols["size"].to_numpy(), block, cols["same"][0].as_py(), int(cols["at"][0].as_py()), cosine)
            some = n > 0
            return pa.record_batch([pa.array(reps[some]), pa.array(n[some].astype(np.int64)), pa.array(reps[root[some]])], names=["rep", "n", "root"])

        for batch in batches:
            if not len(batch):
                continue
            grp = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(grp[1:] != grp[:-1]) + 1), len(grp)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if grp[a] != now:
                    if held and (got := done()):
                        yield got
                    held, now = [], grp[a]
                held.append(batch.slice(a, b - a))
        if held and (got := done()):
            yield got

    found = store(dealt.mapInArrow(count, "rep long, n long, root long"))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (classes.select("embedding", "rep", "size").join(links, "rep", "left").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
             .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(named, "embedding", "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


@query()
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
