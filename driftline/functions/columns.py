"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordinal_of(stage: Column | str, ordinals: dict[str, int]) -> Column:
    """The place of a stage in the expected workflow, null where it has none."""
    stage = F.col(stage) if isinstance(stage, str) else stage
    return lookup(ordinals)[stage]


def lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with fraction, for either timestamp type."""
    span = end - start
    return (F.extract(F.lit("DAY"), span) * 86400 + F.extract(F.lit("HOUR"), span) * 3600
            + F.extract(F.lit("MINUTE"), span) * 60 + F.extract(F.lit("SECOND"), span).cast("double"))


def signature(*parts: Column | str) -> Column:
    """Key under which failures of one shape are found again."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)
