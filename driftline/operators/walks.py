"""Walking back from symptoms within short sessions: all of a session's edges meet in one task, once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.shipping import ship

OUT_ROWS = 20_000


def back_from(before: dict[int, list[int]], symptom: int, depth: int | None) -> Iterator[tuple[int, int, tuple[int, ...]]]:
    """(step, depth, path) of every step reached over at most ``depth`` edges, least depth and on it the smallest path; the symptom first."""
    seen, front, level = {symptom}, {symptom: (symptom,)}, 0
    while front:
        for step in sorted(front):
            yield step, level, front[step]
        if depth is not None and level >= depth:
            return
        new: dict[int, tuple[int, ...]] = {}
        for step, path in front.items():
            for src in before.get(step, ()):
                if src not in seen:
                    way = (*path, src)
                    if src not in new or way < new[src]:
                        new[src] = way
        seen.update(new)
        front, level = new, level + 1


def walk_sessions(steps: DataFrame, symptoms: DataFrame, depth: int | None, tasks: int) -> DataFrame:
    """(session_id, symptom_id, symptom_step, step_id, depth, path) for symptoms (session_id, symptom_id, symptom_step) and edges (session_id, src, dst).

    One shuffle by session; a task holds one session's edges at a time. Sessions are known by equal ids; ids of steps are not null.
    """
    ship(steps.sparkSession)
    edges = steps.select("session_id", F.lit(0).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"))
    asked = symptoms.select("session_id", F.lit(1), F.col("symptom_id"), F.col("symptom_step").cast("long"))
    rows = edges.union(asked).repartition(tasks, "session_id").sortWithinPartitions("session_id", "kind")
    schema = T.StructType([steps.schema["session_id"], T.StructField("symptom_id", T.LongType()), T.StructField("symptom_step", T.IntegerType()),
                           T.StructField("step_id", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("path", T.ArrayType(T.LongType()))])
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64())]

    def walk(batches):
        now, before = None, {}
        out: list[list] = [[] for _ in range(6)]
        session_type = None

        def give():
            batch = pa.RecordBatch.from_arrays([pa.array(out[0], session_type), *(pa.array(c, k) for c, k in zip(out[1:], kinds))], names=schema.names)
            for c in out:
                c.clear()
            return batch

        for batch in batches:
            session_type = batch.schema.field(0).type
            for session, kind, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if session != now or now is None:
                    now, before = session, {}
                if kind == 0:
                    before.setdefault(b, []).append(a)
                    continue
                for step, far, path in back_from(before, a, depth):
                    for c, v in zip(out, (session, a, b, step, far, path)):
                        c.append(v)
                    if len(out[0]) >= OUT_ROWS:
                        yield give()
        if out[0]:
            yield give()

    return rows.mapInArrow(walk, schema)
