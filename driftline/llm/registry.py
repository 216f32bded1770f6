"""The queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from driftline.functions.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL giving the same rows if there is any."""
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> None:
    """Before Python tasks: the package is sent along, and Arrow batches get 2,000 rows where the session leaves Spark's 10,000.

    Rows here hold whole texts, which a worker has in memory a batch at a time.
    """
    ship(spark)
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2000")


def give_back() -> None:
    """Hand memory that this process has freed to the machine; Arrow's pool and the C library would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


def tidy(work: Callable) -> Callable:
    """``work`` for mapInArrow, whose worker gives memory back when a task ends: idle workers wait beside those of the next stage."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def small_batches(spark: SparkSession) -> None:
    """``ready``, with Arrow batches of about 2 MB where the session leaves Spark's 64; a longer row is a batch of its own."""
    ready(spark)
    if spark.conf.get(ARROW_BYTES) in ("67108864b", "64MB"):
        spark.conf.set(ARROW_BYTES, str(2 << 20))


_HELD: dict = {}


def only(key, build: Callable[[], object]):
    """What ``build`` made for ``key``, kept by a worker until it needs another: one large model or store at a time."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def shielded(df: DataFrame, *needed: str) -> DataFrame:
    """``df`` with all but the ``needed`` columns under numbers, so that no name of theirs clashes; ``toDF`` gives the names back."""
    return df.toDF(*[c if c in needed else f"_{i}" for i, c in enumerate(df.columns)])


def widened(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    """A copy of ``schema`` with more fields at its end."""
    return T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in fields.items())])


def slices(batch, at: int, most: int):
    """Consecutive parts of an Arrow batch whose values in column ``at`` (text or binary) come to ``most`` bytes; a longer value is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before, start = np.concatenate([[0], np.cumsum(sizes)]), 0
    while start < batch.num_rows:
        to = max(start + 1, int(np.searchsorted(before, before[start] + most, "right")) - 1)
        yield batch.slice(start, to - start)
        start = to
