"""Nearest earlier vectors, all of them: pivots rule out blocks, short products rule out pairs, what is left is compared.

Cases lie in blocks of one pivot's neighbourhood and a narrow range of angles to it, so a huge neighbourhood is many blocks. By the
triangle inequality no case of a block is nearer to a query than the gap between the query's angle to a pivot and the block's range of angles to
it. Chunks of queries meet tiles of neighbouring blocks in one task, a part of all rows each, so that vectors are sent only as often as there are
tiles, however few blocks can be ruled out. A first round visits the tile that a query would lie in, the second all others; both only blocks that can still
hold something better than the k-th found. Queries and cases that meet are in order of time, so later cases are not looked at, and are multiplied in
single precision; only pairs that come within its error of the k best so far are compared in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.accumulators import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.shipping import ship
from driftline.functions.sizing import store

CASE_ROWS = 1_024                       # of a block, about
QUERY_ROWS, TILES, MOST_ROWS = 8_192, 12, 65_536    # queries and cases that meet in one task: so many, or a part of all, or so many at most
MOST_BLOCKS = 65_536                    # beyond it blocks grow instead
MOST_PIVOTS = 1_024
REFERENCES = 8                          # pivots whose angles every block knows
SLACK = 1e-8                            # cosines are compared at nine digits
SOME = 512                              # queries compared at a time
FOUND = 1 << 18                         # pairs kept to be compared to the end
VALUES = 1 << 20                        # of vectors that a task multiplies at a time


def whole(v, dim: int):
    """Whether a vector has ``dim`` finite numbers that are not all zero."""
    return (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def unit(column, dim: int) -> np.ndarray:
    """Vectors of an Arrow column at length 1."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64, copy=False)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1, 1))


def ranks(*columns) -> list[np.ndarray]:
    """Places of the values of all columns in one order, -1 for null, whatever their type."""
    chunks = [c for x in columns for c in (x.chunks if isinstance(x, pa.ChunkedArray) else [x])]
    values = pa.chunked_array(chunks).combine_chunks()
    rank = np.where(pc.is_valid(values).to_numpy(zero_copy_only=False), pc.rank(values, "ascending", tiebreaker="dense").to_numpy().astype(np.int64), -1)
    return np.split(rank, np.cumsum([len(x) for x in columns])[:-1])


def best(k: int, i: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which entries are the ``k`` best of each ``i``: those of greatest value, of equal ones of smallest place."""
    order = np.lexsort((place, -value, i))
    of = i[order]
    start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]][:len(of)])
    return order[np.arange(len(of)) - np.repeat(start, np.diff(np.r_[start, len(of)])) < k]


def add(held: np.ndarray, top: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray, value: np.ndarray) -> None:
    """Put cases ``j`` of values ``value``, sorted by query ``i`` and at most k of each, among the k best of each query: ``held`` with values ``top``, best first."""
    own, start, n = np.unique(i, return_index=True, return_counts=True)
    k = held.shape[1]
    both, values = np.full((len(own), 2 * k), -1), np.full((len(own), 2 * k), -2.0)
    both[:, :k], values[:, :k] = held[own], top[own]
    row = np.repeat(np.arange(len(own)), n)
    column = k + np.arange(len(i)) - start[row]
    both[row, column], values[row, column] = j, value
    order = np.lexsort((place[both], -values), axis=1)[:, :k]
    held[own], top[own] = np.take_along_axis(both, order, 1), np.take_along_axis(values, order, 1)


def earlier(then, now) -> np.ndarray:
    """Whether each of ``then`` (columns) is known and before each of ``now`` (rows), whatever the type of both."""
    a, b = ranks(now, then)
    return (b[None, :] < a[:, None]) & (b[None, :] >= 0)


def products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scalar products of rows ``i`` of a and ``j`` of b; at most about ``VALUES`` numbers are copied at a time."""
    out, most = np.empty(len(i)), max(1, VALUES // a.shape[1])
    for s in range(0, len(i), most):
        out[s:s + most] = np.einsum("ij,ij->i", a[i[s:s + most]], b[j[s:s + most]])
    return out


def placed(df: DataFrame, vector: str, pivots: np.ndarray, dim: int) -> DataFrame:
    """``df`` with its nearest pivot as ``_cell``, and ``_angles``: to that one, then to the reference pivots."""
    at = df.columns.index(vector)
    schema = T.StructType([*df.schema.fields, T.StructField("_cell", T.LongType()), T.StructField("_angles", T.ArrayType(T.DoubleType()))])

    def tag(batches):
        for batch in batches:
            if batch.num_rows:
                all_ = angles(unit(batch.column(at), dim), pivots)
                cell = all_.argmin(1)
                own = np.column_stack([all_[np.arange(len(cell)), cell], all_[:, :REFERENCES]])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), own.shape[1]).cast(pa.list_(pa.float64()))], names=schema.names)

    return df.mapInArrow(tag, schema)


def laid_out(df: DataFrame, rows: int, n: int, by: str, number: Column, name: str) -> DataFrame:
    """``df`` stored in parts of about ``rows`` rows, each of neighbouring cells and angles to their pivots, with ``number`` as ``name``."""
    parts = max(1, min(MOST_BLOCKS, math.ceil(n / rows)))
    ranged = df.repartitionByRange(parts, F.col("_cell"), F.col("_angles")[0], F.col(by))
    return store(ranged.withColumn(name, number))


def nearest(asked: DataFrame, past: DataFrame, k: int, dim: int, compared: Accumulator | None = None) -> DataFrame:
    """(query_id, case_id, cause, cosine): among them the best ``k`` cases of every query, by cosine at nine digits, then case_id.

    ``asked`` has query_id, _now and _q, ``past`` case_id, _then, cause and _v; only cases before a query's time count. Repeated rows
    of a query or a case count once: the latest time of a query and the earliest of a case see most; unlike vectors of one id stand each for
    themselves. Vectors that are not ``whole`` are
    like none; unknown times are before and after nothing. ``compared`` is told how many pairs were compared to the end.
    """
    spark = asked.sparkSession
    ship(spark)
    time = asked.select("_now").union(past.select("_then")).schema["_now"].dataType      # of both
    asked = asked.where(whole("_q", dim) & F.col("_now").isNotNull()).groupBy("query_id", "_q").agg(F.max("_now").cast(time).alias("_now"))
    past = store(past.where(whole("_v", dim) & F.col("_then").isNotNull()).groupBy("case_id", "cause", "_v").agg(F.min("_then").cast(time).alias("_then")))
    n_past = past.count()
    out = T.StructType([asked.schema["query_id"], past.schema["case_id"], past.schema["cause"], T.StructField("cosine", T.DoubleType())])
    if not n_past:
        return spark.createDataFrame([], out)
    sample = past.select("_v", F.xxhash64("case_id").alias("_h")).orderBy("_h", "_v").limit(max(1, min(MOST_PIVOTS, 2 * n_past // CASE_ROWS))).select("_v").toArrow()
    pivots = unit(sample.column(0), dim)
    error = (dim + 8) * 2.0 ** -24 + SLACK                          # of a product in single precision, at most

    part = F.spark_partition_id().cast("long")
    past = laid_out(placed(past, "_v", pivots, dim), CASE_ROWS, n_past, "case_id", part * MOST_PIVOTS + F.col("_cell"), "_block")
    asked = store(asked)
    n_asked = asked.count()
    most = [max(QUERY_ROWS, min(MOST_ROWS, n // TILES)) for n in (n_asked, n_past)]
    asked = laid_out(placed(asked, "_q", pivots, dim), most[0], n_asked, "query_id", part, "_chunk")
    per_tile = MOST_PIVOTS * max(1, most[1] // CASE_ROWS)               # neighbouring blocks
    width = 1 + min(REFERENCES, len(pivots))
    stats = past.groupBy("_block").agg(F.min("_cell").alias("cell"), F.min("_then").alias("then"),
                                       F.array(*[F.min(F.col("_angles")[i]) for i in range(width)]).alias("lo"), F.array(*[F.max(F.col("_angles")[i]) for i in range(width)]).alias("hi"))
    stats = stats.orderBy("_block").toArrow()                        # blocks plus pivots rows at most
    blocks = spark.sparkContext.broadcast((stats.column("_block").to_numpy(), stats.column("cell").to_numpy(), stats.column("then").combine_chunks(),
                                           *(stats.column(c).combine_chunks().flatten().to_numpy().reshape(-1, width) for c in ("lo", "hi"))))

    def bounds(vectors: np.ndarray, now, own: np.ndarray) -> np.ndarray:
        """The least angle that a case of each of the blocks ``own`` (columns) can have to each query (rows); infinite if none is earlier."""
        _, cell, then, lo, hi = blocks.value
        cell, lo, hi = cell[own], lo[own], hi[own]
        used = np.unique(np.r_[np.arange(width - 1), cell])             # reference pivots stay in front
        to = angles(vectors, pivots[used])
        cell = np.searchsorted(used, cell)
        bound = np.maximum(lo[:, 0] - to[:, cell], to[:, cell] - hi[:, 0])
        for r in range(width - 1):
            np.maximum(bound, np.maximum(lo[:, r + 1] - to[:, r:r + 1], to[:, r:r + 1] - hi[:, r + 1]), out=bound)
        bound[~earlier(then.take(pa.array(own)), now)] = np.inf
        return bound

    def steps(rows: int, columns: int):
        size = max(1, (1 << 18) // max(1, columns))
        return [slice(s, s + size) for s in range(0, rows, size)]

    def settled(batches):
        """Each query with the block it would lie in as ``_home``, in place of its cell and angles."""
        number, cell, _, lo, _ = blocks.value
        starts = cell + lo[:, 0] / 4                                    # angles are below 4
        for batch in batches:
            angle = batch.column(at["_angles"]).flatten().to_numpy().reshape(batch.num_rows, width)[:, 0]
            home = number[np.maximum(np.searchsorted(starts, batch.column(at["_cell"]).to_numpy() + angle / 4, "right") - 1, 0)]
            yield pa.RecordBatch.from_arrays([*[batch.column(at[c]) for c in keep], pa.array(home)], names=[*keep, "_home"])

    def reach(floor: np.ndarray) -> np.ndarray:
        """The greatest angle of what is as good as the floor."""
        return np.arccos(np.clip(floor - SLACK, -1, 1)) + 1e-6

    def meet(queries: DataFrame, again: bool) -> DataFrame:
        """The best ``k`` of every query in each tile it visits; whole chunks of queries go to tiles, so that rows are sent as often as there are tiles."""

        def visits(batches):
            number, to = blocks.value[0], {}
            for batch in batches:
                for s in steps(batch.num_rows, len(number)):
                    own = batch.slice(s.start, s.stop - s.start)
                    goes = (own.column("_home").to_numpy()[:, None] // per_tile == number // per_tile) ^ again
                    if again:
                        goes &= bounds(unit(own.column("_q"), dim), own.column("_now"), np.arange(len(number))) <= reach(own.column("_floor").to_numpy())[:, None]
                    chunk = own.column("_chunk").to_numpy()
                    for c in np.unique(chunk):
                        to[c] = to.get(c, False) | goes[chunk == c].any(axis=0)
            for c, of in to.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(of.sum(), c)), pa.array(number[of])], names=["_c", "_b"])

        def compare(q: pa.Table, c: pa.Table) -> pa.Table:
            if not len(q) or not len(c):
                return out_of(q, c, *(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)))
            q, c = q.sort_by("_now"), c.sort_by([("_block", "ascending"), ("_then", "ascending")])
            asks, cases = unit(q["_q"], dim), unit(c["_v"], dim)
            short_asks, short_cases = asks.astype(np.float32), cases.astype(np.float32)
            now, then = ranks(q["_now"], c["_then"])
            place, = ranks(c["case_id"])
            floor, home = q["_floor"].to_numpy().copy(), q["_home"].to_numpy()
            numbers, starts = np.unique(c["_block"].to_numpy(), return_index=True)
            own = np.searchsorted(blocks.value[0], numbers)
            bound = np.concatenate([bounds(asks[s], q["_now"].slice(s.start, s.stop - s.start), own).astype(np.float32) for s in steps(len(q), len(own))])
            bound[(home // per_tile == numbers[0] // per_tile) == again] = np.inf       # met in the other round
            held, top = np.full((len(q), k), -1), np.full((len(q), k), -2.0)
            found, n_found = [], 0

            def settle_found():
                """Compare in double precision what was found, and raise the floors."""
                nonlocal found, n_found
                i, j = (np.concatenate(x) for x in zip(*found))
                found, n_found = [], 0
                value = np.round(products(asks, cases, i, j), 9)
                if compared is not None:
                    compared.add(len(i))
                good = value >= floor[i]
                i, j, value = i[good], j[good], value[good]
                kept = best(k, i, place[j], value)
                add(held, top, place, i[kept], j[kept], value[kept])
                floor[i] = np.maximum(floor[i], top[i, -1])

            parts = list(zip(numbers, range(len(numbers)), starts, np.r_[starts[1:], len(c)]))
            for first, (number, b, x, y) in [(f, p) for f in ([False] if again else [True, False]) for p in parts]:
                at = np.flatnonzero((bound[:, b] <= reach(floor)) & (bound[:, b] < np.inf) & ((home == number) == first))
                for s in range(0, len(at), SOME):
                    rows = at[s:s + SOME]
                    sure, end = x + np.searchsorted(then[x:y], now[rows[[0, -1]]])      # all see cases before the one, none from the other on
                    if end == x:
                        continue
                    near = short_asks[rows] @ short_cases[x:end].T
                    if sure < end:
                        np.copyto(near[:, sure - x:], -2, where=then[sure:end] >= now[rows, None])
                    limit = floor[rows] - error
                    new = np.flatnonzero(limit < -1)
                    if len(new) and end - x >= k:
                        limit[new] = np.partition(near[new], -k, axis=1)[:, -k] - 2 * error
                    limit = np.maximum(limit, -1.5).astype(np.float32)
                    some = np.flatnonzero(near.max(axis=1) >= limit)
                    i, j = np.nonzero(near[some] >= limit[some, None])
                    found.append((rows[some[i]], x + j))
                    n_found += len(i)
                    if n_found > FOUND:
                        settle_found()
                if n_found:
                    settle_found()
            i, n = np.nonzero(held >= 0)
            return out_of(q, c, i, held[i, n], top[i, n])

        def out_of(q: pa.Table, c: pa.Table, i: np.ndarray, j: np.ndarray, value: np.ndarray) -> pa.Table:
            return pa.table({"query_id": q["query_id"].take(pa.array(i)), "case_id": c["case_id"].take(pa.array(j)), "cause": c["cause"].take(pa.array(j)), "cosine": pa.array(value)})

        pairs = store(queries.mapInArrow(visits, "_c long, _b long").distinct()).withColumn("_tile", F.floor(F.col("_b") / per_tile))
        cases = past.select("_block", "case_id", "cause", "_v", "_then").join(pairs, F.col("_block") == F.col("_b"))
        goes = queries.join(pairs.select("_c", F.col("_tile").alias("_t")).distinct(), F.col("_chunk") == F.col("_c")).drop("_c")
        return store(goes.groupBy("_chunk", "_t").cogroup(cases.groupBy("_c", "_tile")).applyInArrow(compare, out))

    at, keep = {c: i for i, c in enumerate(asked.columns)}, [c for c in asked.columns if c not in ("_cell", "_angles")]
    asked = store(asked.mapInArrow(settled, T.StructType([*[asked.schema[c] for c in keep], T.StructField("_home", T.LongType())])))
    one = meet(asked.withColumn("_floor", F.lit(-2.0)), False)
    order = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "case_id")
    floors = one.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k).select("query_id", F.col("cosine").alias("_floor"))
    again = asked.join(floors, "query_id", "left").withColumn("_floor", F.coalesce("_floor", F.lit(-2.0)))
    return one.unionByName(meet(store(again.repartition("_chunk")), True))
