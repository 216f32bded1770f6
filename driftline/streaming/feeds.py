"""Ingest, repeats, sessions, rates, claims, skipped steps and late rows on streams."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from driftline.functions.columns import ordinal_of
from driftline.functions.sizing import settle, shared_dir, small_side, store
from driftline.session import SETTINGS
from driftline.sources import schemas

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def stream_trace(spark: SparkSession, path: str, schema: str = schemas.TRACE, form: str = "parquet",
                 files: str | None = None, max_files: int | None = None) -> DataFrame:
    """Session reports as they arrive in a folder."""
    reader = spark.readStream.schema(schema).format(form)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_dedup(df: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """Drop re-sent events that arrive within the delay."""
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def stream_sessions(df: DataFrame, key: str, gap: str, delay: str) -> DataFrame:
    """Sessions by inactivity, given out once no more of their rows can come."""
    return df.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("_w"), key).agg(
        F.count("*").alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).drop("_w")


def stream_rates(df: DataFrame, bad, window: str, slide: str | None, delay: str, by: list[str] | None = None) -> DataFrame:
    """Share of deviating rows per tumbling (no ``slide``) or sliding window."""
    spans = F.window("ts", window, slide) if slide else F.window("ts", window)
    rates = df.withWatermark("ts", delay).groupBy(spans.alias("_w"), *(by or [])).agg(
        F.count("*").alias("n_rows"), F.count_if(bad).alias("n_bad"))
    return rates.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *(by or []),
                        "n_rows", "n_bad", (F.col("n_bad") / F.col("n_rows")).alias("rate"))


def stream_claims(claims: DataFrame, evidence: DataFrame, key: str, within: str, delay: str, buckets: int = 4) -> DataFrame:
    """Claims without evidence in the interval before them.

    Evidence shrinks to first and last time per key and bucket (a fraction of the interval)
    before the join, so a claim meets at most ``buckets`` + 1 rows however busy its key is.
    Evidence of a bucket supports a claim when its first lies before the claim and its last
    is recent enough.
    """
    width = f"{max(1, _micros(claims.sparkSession, within) // buckets)} microseconds"
    proofs = (evidence.withWatermark("ts", delay).groupBy(F.col(key).alias("_key"), F.window("ts", width).alias("_w"))
              .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
              .select("_key", "_first", "_last", F.window_time("_w").alias("_at")))
    told = claims.withWatermark("ts", delay)
    near = F.expr(f"_at >= ts - interval {within} and _at <= ts + interval {width}")
    joined = told.join(proofs, (F.col(key) == F.col("_key")) & near & (F.col("_first") < F.col("ts"))
                       & (F.col("_last") >= F.col("ts") - F.expr(f"interval {within}")), "leftOuter")
    return joined.where("_key is null").drop("_key", "_first", "_last", "_at")


def _micros(spark: SparkSession, interval: str) -> int:
    """An interval such as ``12 hours`` in microseconds, read by Spark itself."""
    start = "timestamp'2000-01-01'"
    return spark.sql(f"select unix_micros({start} + interval {interval}) - unix_micros({start}) as m").first()["m"]


def stream_skips(df: DataFrame, ordinals: dict[str, int], delay: str, forget: str = "30 days") -> DataFrame:
    """Rows that skip a stage, the furthest stage of each session being kept across batches.

    Sessions are cut off by the caller through ``session_id``. Rows wait until the watermark has passed them and are then taken in
    time order, so it does not matter which batch brings them. A session without rows for ``forget`` starts
    anew. Only time, id and stage, as a number, reach Python, and all rows that a session gets at once are one value of its state. Rows without time or session have no place in an order and are left out; steps without an id
    count, and come first of equal times.
    """
    from pyspark import cloudpickle

    from driftline.streaming import skips

    cloudpickle.register_pickle_by_value(skips)     # the runner of a stream's state does not see shipped files
    forget_ms = _micros(df.sparkSession, forget) // 1000
    placed = df.where("ts is not null and session_id is not null").withWatermark("ts", delay).select(
        "session_id", "ts", F.unix_micros("ts").alias("us"), F.coalesce("step_id", F.lit(skips.UNNUMBERED)).alias("step_id"),
        ordinal_of("stage", {stage: k for k, stage in enumerate(ordinals)}).cast("int").alias("stage"))
    found = placed.where("stage is not null").groupBy("session_id").transformWithStateInPandas(
        statefulProcessor=skips.SkipProcessor(forget_ms, ordinals), outputStructType="session_id string, step_id bigint, stage string, reached int",
        outputMode="Append", timeMode="EventTime")
    return found.withColumn("step_id", F.when(F.col("step_id") != skips.UNNUMBERED, F.col("step_id")))


def judge_arrivals(sessions: DataFrame, judge: Callable[[DataFrame], DataFrame], name: str, base: str | None = None) -> str:
    """Judge complete sessions as their reports arrive; gives the folder of the stream.

    Every batch holds whole sessions and goes through ``judge``, a batch operator or flow. What it finds lies in a folder named by the
    batch, written anew if the batch is run again after a failure, so nothing is told twice. Read it with ``judged``.
    """
    base = base or f"{shared_dir(sessions.sparkSession)}/streams/{name}-{uuid.uuid4().hex}"

    def one(rows: DataFrame, batch: int) -> None:
        judge(rows).write.mode("overwrite").parquet(f"{base}/rows/batch={batch}")

    query = (sessions.writeStream.foreachBatch(one).option("checkpointLocation", f"{base}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return base


def judged(spark: SparkSession, base: str) -> DataFrame:
    """All findings of a stream of sessions, with the batch that brought them."""
    return spark.read.parquet(f"{base}/rows")


def upsert_reports(reports: DataFrame, judge: Callable[[DataFrame], DataFrame], name: str, version: str = "report", buckets: int = 64,
                   base: str | None = None, forget: str | None = None) -> str:
    """Judge reports that may be sent again, grown, or out of turn; gives the folder of the stream.

    A session's findings are those of its report of greatest ``version``: a newer report replaces all that an older one
    left, an equal or older one changes nothing. Sessions and findings lie by session bucket in two tables, and a batch rewrites only the buckets it
    touches, so a batch that is run again after a failure ends the same. A report's rows come in one batch; rows of a step that it holds twice count once. With ``forget``,
    sessions whose last row lies so far behind the latest of all in their bucket leave both tables. Read it with ``current``.
    """
    spark = reports.sparkSession
    base = base or f"{shared_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    bucket = F.pmod(F.xxhash64("session_id"), F.lit(buckets)).cast("int").alias("_bucket")
    key = ["session_id"]

    def stored(part: str, like: DataFrame, touched: list[int]) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{part}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return like.limit(0)
        return spark.read.schema(like.schema).parquet(f"{base}/{part}").where(F.col("_bucket").isin(touched))

    def replace(rows: DataFrame, part: str) -> None:
        store(rows).write.partitionBy("_bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{base}/{part}")

    def one(rows: DataFrame, batch: int) -> None:
        sent = settle(rows.groupBy(*key).agg(F.max(version).alias("_version"), F.max("ts").alias("_last")).withColumn("_bucket", bucket))
        touched = sorted(r[0] for r in sent.select("_bucket").distinct().collect())     # `buckets` of them at most
        if not touched:
            return
        sessions = store(stored("sessions", sent, touched))
        was = sessions.select(F.col("session_id").alias("_s"), F.col("_version").alias("_known"))
        newer = settle(sent.join(was, F.col("session_id").eqNullSafe(F.col("_s")), "left").where("_known is null or _version > _known").select(*sent.columns))
        one_each = small_side(newer.select(F.col("session_id").alias("_s"), F.col("_version").alias("_v")))
        own = rows.join(one_each, F.col("session_id").eqNullSafe(F.col("_s")) & (F.col(version) == F.col("_v")), "left_semi").drop(version)
        found = judge(own.dropDuplicates(["session_id", "step_id"])).withColumn("_bucket", bucket)
        versions = newer.select(F.col("session_id").alias("_s"), "_version")
        found = store(found.join(versions, F.col("session_id").eqNullSafe(F.col("_s"))).drop("_s"))
        rest = sessions.join(newer.select(F.col("session_id").alias("_s")), F.col("session_id").eqNullSafe(F.col("_s")), "left_anti")
        kept = rest.unionByName(newer)
        if forget:
            late = F.max("_last").over(Window.partitionBy("_bucket")) - F.expr(f"interval {forget}")
            kept = kept.withColumn("_late", late).where(F.col("_last").isNull() | (F.col("_last") >= F.col("_late"))).drop("_late")
        kept = settle(kept)
        old = stored("findings", found, touched).join(newer.select(F.col("session_id").alias("_s")), F.col("session_id").eqNullSafe(F.col("_s")), "left_anti")
        alive = kept.select(F.col("session_id").alias("_s"))
        replace(old.unionByName(found).join(alive, F.col("session_id").eqNullSafe(F.col("_s")), "left_semi"), "findings")
        replace(kept, "sessions")

    query = (reports.writeStream.foreachBatch(one).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return base


def current(spark: SparkSession, base: str) -> DataFrame:
    """Findings of each session's newest report, with its version."""
    sessions = spark.read.parquet(f"{base}/sessions").select(F.col("session_id").alias("_s"), F.col("_version").alias("_v"))
    found = spark.read.parquet(f"{base}/findings")
    # A bucket that lost its last finding keeps the old file: its rows are of a version no longer known.
    same = F.col("session_id").eqNullSafe(F.col("_s")) & (F.col("_version") == F.col("_v"))
    return found.join(sessions, same, "left_semi").drop("_bucket").withColumnRenamed("_version", "report")


class Batches(StreamingQueryListener):
    """Rows read and rows dropped as too late of every batch of a run, however many there are."""

    def __init__(self):
        self.seen: dict[str, list[tuple[int, int, int]]] = {}
        self.ended: dict[str, threading.Event] = {}

    def of(self, run: str) -> list[tuple[int, int, int]]:
        """What the run's batches told, once all of it has arrived."""
        if not self.ended.setdefault(run, threading.Event()).wait(60):
            raise TimeoutError("the end of the stream was not reported")
        return self.seen.get(run, [])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)
        self.seen.setdefault(str(p.runId), []).append((int(p.batchId), int(p.numInputRows), late))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()


def run_available(df: DataFrame, name: str, base: str | None = None) -> tuple[str, list[tuple[int, int, int]]]:
    """Run a stream over what has arrived, into a folder of the shared storage.

    Gives the folder and for each batch its number, rows read and rows dropped as too late; pass a folder again to go on from its state.
    State is kept in RocksDB, which holds more than memory and which custom state needs.
    """
    spark = df.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    base = base or f"{shared_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    batches = Batches()
    spark.streams.addListener(batches)
    try:
        query = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state")
                 .trigger(availableNow=True).start(f"{base}/rows"))
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
        query.awaitTermination()
        return base, batches.of(str(query.runId))
    finally:
        spark.streams.removeListener(batches)


def result_of(df: DataFrame, name: str) -> DataFrame:
    """Rows a stream gives for what has arrived."""
    base, _ = run_available(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/rows")


def stream_late(spark: SparkSession, batches: list[tuple[int, int, int]]) -> DataFrame:
    """Batch, rows read and rows dropped as too late, one row per batch."""
    return spark.createDataFrame(batches, "batch bigint, n_rows bigint, late bigint")
