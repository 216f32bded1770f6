"""Runs registered queries beside their SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int"}


def compare(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    got = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    want = rel.fetchall()
    names = sorted(spark_df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} against {sorted(rel.columns)}"
    kinds = dict(spark_df.dtypes)
    for name, kind in zip(rel.columns, rel.types):
        if KINDS.get(str(kind)) != kinds[name]:
            return f"type of {name}: {kinds[name]} against {kind}"
    a, b = rows_of(spark_df.columns, got), rows_of(rel.columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{names}: {x} against {y}"
    return None if a else "no rows"
