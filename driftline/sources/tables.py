"""Reading and writing the canonical tables."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.functions.ordered import ORDER, SEG, segment, session_key
from driftline.functions.sizing import small_side
from driftline.sources import schemas


def _read(spark: SparkSession, path: str, schema: str, form: str) -> DataFrame:
    if form not in ("parquet", "json", "orc"):
        raise ValueError(f"unknown table form: {form}")
    return spark.read.schema(schema).format(form).load(path)


def read_trace(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Complete recorded sessions."""
    return _read(spark, path, schemas.TRACE, form)


def store_trace(df: DataFrame, path: str, buckets: int = 200) -> None:
    """Keep a trace so that what asks for whole sessions needs no shuffle any more.

    Rows lie in ``buckets`` files by session, in order. Long sessions are cut here once and for all: their rows carry the
    piece they belong to in the column ``seg`` and lie in buckets by session and piece. ``path`` gets the rows and their layout.
    """
    spark = df.sparkSession
    rows = df if SEG in df.columns else segment(df, session_key(df), [*ORDER])
    cut = [c for c in (SEG,) if c in rows.columns]
    name = f"stored_{uuid.uuid4().hex}"
    try:
        (rows.repartition(buckets, "session_id", *cut).write.bucketBy(buckets, "session_id", *cut).sortBy("session_id", *cut, *ORDER)
         .option("path", f"{path}/rows").format("parquet").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")          # the files stay
    layout = spark.createDataFrame([(rows.schema.json(), buckets, ["session_id", *cut])], "schema string, buckets int, by array<string>")
    layout.coalesce(1).write.json(f"{path}/layout")


def open_trace(spark: SparkSession, path: str) -> DataFrame:
    """A stored trace with its buckets: windows and groups by session, and by session and piece, plan no exchange."""
    layout = spark.read.schema("schema string, buckets int, by array<string>").json(f"{path}/layout").first()
    name = f"stored_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    columns = StructType.fromJson(json.loads(layout["schema"])).toDDL()
    order = ", ".join([*layout["by"], *ORDER])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(layout['by'])}) "
              f"SORTED BY ({order}) INTO {layout['buckets']} BUCKETS LOCATION '{path}/rows'")
    return spark.table(name)


def read_spec(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Runtime rules; hinted for broadcast when the file is within bounds."""
    return small_side(_read(spark, path, schemas.SPEC, form))


def read_feedback(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Business problems and user feedback."""
    return _read(spark, path, schemas.FEEDBACK, form)


def read_verdicts(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Expert verdicts: confirm, correct or insufficient."""
    return _read(spark, path, schemas.VERDICTS, form)


def read_gates(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Checks that a run met on its way, and whether they let it pass."""
    return _read(spark, path, schemas.GATES, form)


def read_evidence(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Evidence recorded apart from the trace."""
    return _read(spark, path, schemas.PROOFS, form)


def read_results(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Outcomes of evaluation cases by version."""
    return _read(spark, path, schemas.RESULTS, form)


def read_ledger(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Decisions on versions."""
    return _read(spark, path, schemas.LEDGER, form)


def read_routing(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """What kind of thing to change for a cause; hinted for broadcast when within bounds."""
    return small_side(_read(spark, path, schemas.ROUTING, form))


def read_advice(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Advice by kind of rule; hinted for broadcast when within bounds."""
    return small_side(_read(spark, path, schemas.ADVICE, form))


def read_votes(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Verdicts of several verifiers on a finding."""
    return _read(spark, path, schemas.VOTES, form)


def _write(df: DataFrame, path: str, form: str, by: list[str], mode: str) -> None:
    # Rows are dealt so that a value of ``by`` lies in few files; Spark splits large values and puts small ones together.
    if by:
        df = df.hint("rebalance", *by)
    df.write.mode(mode).partitionBy(*by).format(form).save(path)


def write_findings(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    """Local findings, laid out by skill so one skill is read without the rest."""
    _write(df.withColumn("skill", F.coalesce("skill", F.lit("none"))), path, form, ["skill"], mode)


def write_reports(df: DataFrame, path: str, form: str = "json", mode: str = "errorifexists") -> None:
    """Attribution reports, one nested row per session."""
    _write(df, path, form, [], mode)


def write_evalset(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    """Reusable cases, laid out by set."""
    _write(df, path, form, ["set_name"], mode)
