"""Cutting lineage and broadcasting behind a size check."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for durable intermediate data.

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):     # a local-cluster has machines of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute once into the durable shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Write a large result that several steps read as a table in the shared folder.

    Unlike ``settle`` it is columnar: each reader scans only the columns it needs. Tables lie
    in a folder per application, to be removed when it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer splits than that, else ``df`` as it is.

    For work heavy per row on few files; a large table has splits enough and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether all of ``df`` fits the stated bounds; looks at ``max_rows + 1`` rows at most."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``df`` is within the bounds, else leave a shuffle join to Spark.

    Pass something cheap to count: a file, an inline table or a ``settle``d result.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
