"""Running computations along ordered groups that stay parallel when one group is huge.

A window task holds one whole group, so a session with a third of all rows would
end in one task. ``segment`` finds such groups and cuts them, in order, into pieces
marked by the column ``seg``; it adds no column when there are none. ``running``
then works per (group, piece) and adds to each piece what the earlier pieces of its
group carry over. Without a ``seg`` column it is a plain window.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.sizing import settle, small_side, store

SEG = "seg"
MAX_GROUP_ROWS = 2_000_000
# Bounds the number of range tasks, not the rows: pieces grow instead, and windows spill.
MAX_PIECES = 10_000
ORDER = ("ts", "step_id")


def session_key(df: DataFrame) -> list[str]:
    """Columns naming a session. ``owner`` is kept in front when rows were grouped by it."""
    return [c for c in ("owner", "session_id") if c in df.columns]


def run_key(df: DataFrame) -> list[str]:
    """Columns naming one run: the skill window where rows are cut into windows, else the session."""
    return [c for c in ("owner", "session_id", "window_id") if c in df.columns]


def carried(df: DataFrame, *more: str) -> list[str]:
    """Key columns an operator passes on: session, window and piece, where present."""
    wanted = ("owner", "session_id", "window_id", SEG, *more)
    return [c for c in wanted if c in df.columns]


def segment(df: DataFrame, key: list[str], order: list[str], max_rows: int | None = None) -> DataFrame:
    """Mark the pieces of groups longer than ``max_rows``; other rows get piece 0.

    The first pass reads the key columns only. Pieces come from a range shuffle of
    the long groups alone and are stored, as a re-run could sample other bounds. Rows of a null
    key are a group like any other; they are often the longest.
    """
    max_rows = max_rows or MAX_GROUP_ROWS
    sizes = df.groupBy(*key).count().where(F.col("count") > max_rows)
    found = sizes.agg(F.count("*").alias("keys"), F.sum("count").alias("rows")).first()
    if not found["keys"]:
        return df
    pieces = min(-(-2 * found["rows"] // max_rows), MAX_PIECES)
    long_keys = small_side(settle(sizes.select(F.struct(*key).alias("_long"))))
    long = F.struct(*key) == F.col("_long")     # equal structs may hold nulls
    long_rows = store(
        df.join(long_keys, long, "left_semi")
        .repartitionByRange(int(pieces), *key, *order)
        .withColumn(SEG, F.spark_partition_id() + 1)
    )
    rest = df.join(long_keys, long, "left_anti").withColumn(SEG, F.lit(0))
    return rest.unionByName(long_rows)


@dataclass(frozen=True)
class Run:
    """One running column; build it with the functions below."""

    kind: str
    value: Column
    inclusive: bool = False
    k: int = 0


def previous(value) -> Run:
    """The value on the row before."""
    return Run("previous", _col(value))


def last_known(value, inclusive: bool = False) -> Run:
    """The latest non-null value so far."""
    return Run("last_known", _col(value), inclusive)


def running_sum(value, inclusive: bool = True) -> Run:
    return Run("sum", _col(value), inclusive)


def running_max(value, inclusive: bool = False) -> Run:
    return Run("max", _col(value), inclusive)


def running_min(value, inclusive: bool = False) -> Run:
    return Run("min", _col(value), inclusive)


def last_rows(value, k: int) -> Run:
    """The values of up to ``k`` rows before, oldest first."""
    return Run("rows", _col(value), k=k)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _boxed(value: Column) -> Column:
    """A struct that is null only when the value is."""
    return F.when(value.isNotNull(), F.struct(value.alias("v")))


def running(df: DataFrame, columns: dict[str, Run], key: list[str] | None = None, order=ORDER) -> DataFrame:
    """Add the running ``columns`` along ``order`` within ``key`` (the session by default)."""
    key = key or session_key(df)
    order = list(order)
    if SEG not in df.columns:
        by_order = Window.partitionBy(*key).orderBy(*order)
        return df.withColumns({name: _local(run, by_order) for name, run in columns.items()})

    by_piece = Window.partitionBy(*key, SEG).orderBy(*order)
    at = F.struct(*order)
    before = Window.partitionBy(*key).orderBy(SEG)
    ends = df
    tails = {f"_tail_{n}": F.collect_list(F.struct(r.value.alias("v"))).over(by_piece.rowsBetween(1 - r.k, 0))
             for n, r in columns.items() if r.kind == "rows"}
    if tails:
        ends = ends.withColumns(tails)
    # Only cut groups have pieces above 0, so this stays small and skips all others.
    ends = ends.where(F.col(SEG) > 0).groupBy(*key, SEG).agg(
        *[_summary(n, r, at).alias(f"_{n}") for n, r in columns.items()])
    carry = ends.select(*key, SEG, *[_carry(n, r, before).alias(f"_{n}") for n, r in columns.items()])
    carry = carry.where(reduce(or_, [F.col(f"_{n}").isNotNull() for n in columns]))
    carry = small_side(settle(carry.withColumn("_at", F.struct(*key, SEG)).drop(*key, SEG)))
    local = df.withColumns({name: _local(run, by_piece, boxed=True) for name, run in columns.items()})
    joined = local.join(carry, F.struct(*key, SEG) == F.col("_at"), "left")
    return joined.withColumns({n: _combine(n, r) for n, r in columns.items()}).drop("_at", *[f"_{n}" for n in columns])


def _local(run: Run, window, boxed: bool = False) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, 0 if run.inclusive else -1)
    if run.kind == "previous":
        return F.lag(F.struct(run.value.alias("v"))).over(window) if boxed else F.lag(run.value).over(window)
    if run.kind == "last_known":
        if boxed:
            return F.last(_boxed(run.value), ignorenulls=True).over(frame)
        return F.last(run.value, ignorenulls=True).over(frame)
    if run.kind == "rows":
        rows = F.collect_list(F.struct(run.value.alias("v"))).over(window.rowsBetween(-run.k, -1))
        return rows if boxed else _values(rows)
    return {"sum": F.sum, "max": F.max, "min": F.min}[run.kind](run.value).over(frame)


def _values(rows: Column) -> Column:
    return F.transform(rows, lambda r: r["v"])


def _summary(name: str, run: Run, at: Column) -> Column:
    """What one piece hands to the pieces after it."""
    if run.kind == "previous":
        return F.max_by(F.struct(run.value.alias("v")), at)
    if run.kind == "last_known":
        return F.max_by(_boxed(run.value), F.when(run.value.isNotNull(), at))
    if run.kind == "rows":
        return F.max_by(F.col(f"_tail_{name}"), at)
    return {"sum": F.sum, "max": F.max, "min": F.min}[run.kind](run.value)


def _carry(name: str, run: Run, before) -> Column:
    col = F.col(f"_{name}")
    frame = before.rowsBetween(Window.unboundedPreceding, -1)
    if run.kind in ("previous", "last_known"):
        return F.last(col, ignorenulls=True).over(frame)
    if run.kind == "rows":
        # Every piece before has a row or more, so k of them are enough.
        rows = F.flatten(F.collect_list(col).over(before.rowsBetween(-run.k, -1)))
        return F.when(F.size(rows) > 0, _newest(rows, run.k))
    return {"sum": F.sum, "max": F.max, "min": F.min}[run.kind](col).over(frame)


def _newest(rows: Column, k: int) -> Column:
    return F.slice(rows, F.greatest(F.size(rows) - k + 1, F.lit(1)), F.lit(k))


def _combine(name: str, run: Run) -> Column:
    here, carried_in = F.col(name), F.col(f"_{name}")
    if run.kind in ("previous", "last_known"):
        return F.coalesce(here, carried_in)["v"]
    if run.kind == "rows":
        return _values(_newest(F.concat(F.coalesce(carried_in, F.slice(here, 1, 0)), here), run.k))
    if run.kind == "sum":
        return F.when(here.isNotNull() | carried_in.isNotNull(),
                      F.coalesce(here, F.lit(0)) + F.coalesce(carried_in, F.lit(0)))
    return F.greatest(here, carried_in) if run.kind == "max" else F.least(here, carried_in)
