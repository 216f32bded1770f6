"""Hand-made traces."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)
SCHEMA = ("session_id string, step int, step_id bigint, ts timestamp, stage string, name string, layer string, kind string, "
          "skill string, artifact_id string, rw string, state map<string,string>, value double, ok boolean")
ORDINALS = {"signup": 1, "view": 2, "click": 3, "purchase": 4}


def trace(spark, sessions: dict[str, list]):
    """``sessions``: id -> rows, each a stage or a dict of columns with ``stage``."""
    rows = []
    for sid, steps in sessions.items():
        for i, s in enumerate(steps, 1):
            s = {"stage": s} if isinstance(s, str) else s
            n = len(rows) + 1
            rows.append((sid, i, s.get("step_id", n), s.get("ts", START + timedelta(minutes=i)), s["stage"], s.get("name", s["stage"]),
                         s.get("layer", "operation"), s.get("kind", "action"), s.get("skill"), s.get("artifact_id"),
                         s.get("rw"), s.get("state", {"k": "1"}), s.get("value", 1.0), s.get("ok", s["stage"] != "error")))
    return spark.createDataFrame(rows, SCHEMA)


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
