"""From raw rows to a trace: columns, layers, levels, sessions, repeats, state, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.functions.columns import lookup, seconds_between
from driftline.functions.ordered import (
    carried, last_known, previous, running, running_sum, session_key)
from driftline.sources import schemas


def normalize(raw: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rows of any source in canonical columns: ``mapping`` gives a SQL expression per column.

    Unmapped columns are typed nulls, so sources can be put together by ``unionByName``.
    ``ts`` keeps the timestamp type of its source.
    """
    wanted = StructType.fromDDL(schemas.TRACE)
    picked = []
    for field in wanted:
        if field.name in mapping:
            value = F.expr(mapping[field.name])
            picked.append((value if field.name == "ts" else value.cast(field.dataType)).alias(field.name))
        else:
            picked.append(F.lit(None).cast(field.dataType).alias(field.name))
    extra = [F.expr(e).alias(n) for n, e in mapping.items() if n not in wanted.fieldNames()]
    return raw.select(*extra, *picked)


def normalize_json(raw: DataFrame, payload: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows that arrive as JSON text: ``paths`` gives path and type per canonical column.

    Text that is no JSON gives nulls, not an error.
    """
    parsed = raw.withColumn("_v", F.try_parse_json(F.col(payload)))
    wanted = parsed.withColumns({n: F.try_variant_get("_v", path, kind) for n, (path, kind) in paths.items()})
    return normalize(wanted, {n: f"`{n}`" for n in paths})


def tag_layer(df: DataFrame, rules: dict[str, str], default: str = "operation") -> DataFrame:
    """Mark each row as operation, cognition or context by its name."""
    return df.withColumn("layer", F.coalesce(lookup(rules)[F.col("name")], F.lit(default)))


def assign_levels(df: DataFrame, task_start: Column) -> DataFrame:
    """Number steps, tasks and stage visits within each session.

    A task opens at ``task_start``; rows before the first one belong to task 0. A stage
    visit ends when the stage changes.
    """
    marked = df.withColumn("_task_start", task_start)
    marked = running(marked, {
        "step": running_sum(F.lit(1)),
        "task_no": running_sum(F.col("_task_start").cast("int")),
        "_stage_before": previous(F.coalesce("stage", F.lit(""))),
    })
    changed = F.col("_stage_before").isNull() | (F.col("_stage_before") != F.coalesce("stage", F.lit("")))
    marked = running(marked.withColumn("_changed", changed.cast("int")), {"stage_no": running_sum("_changed")})
    return marked.withColumns({
        "step": F.col("step").cast("int"),
        "task_id": F.concat_ws("/", "session_id", F.col("task_no").cast("string")),
    }).drop("_task_start", "_stage_before", "_changed", "task_no")


def sessionize(df: DataFrame, key: str, gap: str, order=("ts", "step_id")) -> DataFrame:
    """Give a session id to rows without one: a new session starts after a gap over ``gap``."""
    seen = running(df, {"_ts_before": previous(order[0])}, key=[key], order=order)
    opens = F.col("_ts_before").isNull() | (
        F.col(order[0]) - F.col("_ts_before") > F.expr(f"interval {gap}"))
    seen = running(seen.withColumn("_opens", opens.cast("int")), {"_n": running_sum("_opens")},
                   key=[key], order=order)
    return seen.withColumn("session_id", F.concat_ws("-", F.col(key).cast("string"), F.col("_n").cast("string"))
                           ).drop("_ts_before", "_opens", "_n")


def dedup_events(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first report of each event by ``order``.

    An aggregate, so copies of one event shrink before the shuffle however many there are.
    """
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r"))
    return first.select("_r.*")


def completeness(df: DataFrame, terminal: list[str], key: list[str] | None = None) -> DataFrame:
    """Per session: steps missing inside, share present, last row, whether it ended as it should."""
    key = key or session_key(df)
    seen = df.groupBy(*key).agg(
        F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count("*").alias("n_rows"),
        F.max_by("name", "step").alias("last_name"))
    span = F.col("last_step") - F.col("first_step") + 1
    return seen.select(
        *key, "n_rows", "last_name", (span - F.col("n_rows")).cast("bigint").alias("missing_steps"),
        (F.col("n_rows") / span).alias("present"), F.col("last_name").isin(terminal).alias("ended"))


def explode_state(df: DataFrame) -> DataFrame:
    """One row per step and state field; a null value keeps its row, an absent field has none."""
    return df.select(*carried(df, "step_id", "step", "stage"), F.explode("state").alias("field", "value"))


def skill_windows(df: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Cut a skill's execution windows out of each session.

    A window opens at a start row and lasts until before the next start, through an end
    row, or to the end of the session.
    """
    marked = df.withColumns({"_start": start.cast("int"), "_end": (end if end is not None else F.lit(False)).cast("int")})
    runs = {"window_id": running_sum("_start")}
    if end is not None:
        runs["_ends"] = running_sum("_end", inclusive=False)
    out = running(marked, runs)
    if end is not None:
        out = out.withColumn("_ends", F.coalesce("_ends", F.lit(0)))
        out = running(out, {"_ends_at_start": last_known(F.when(F.col("_start") == 1, F.col("_ends")), inclusive=True)})
        out = out.where(F.col("_ends") == F.col("_ends_at_start"))
    return out.where("window_id > 0").drop("_start", "_end", "_ends", "_ends_at_start")


def window_summary(df: DataFrame) -> DataFrame:
    """Per window: first and last step, length in seconds and rows; one row however long the window is."""
    whole = df.groupBy(*session_key(df), "window_id").agg(
        F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count("*").alias("n_rows"),
        F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))
    return whole.withColumn("seconds", seconds_between(F.col("_t0"), F.col("_t1"))).drop("_t0", "_t1")


def window_names(df: DataFrame) -> DataFrame:
    """The names of each window in order: a row per step, with its place in the window from 1."""
    placed = running(df, {"place": running_sum(F.lit(1))}, key=[*session_key(df), "window_id"])
    return placed.select(*session_key(df), "window_id", F.col("place").cast("bigint").alias("place"), "name")
