"""The secret scan's network, trained in rounds on all findings."""

import random

from driftline.llm import secrets
from pyspark.sql import functions as F


def test_all_findings_are_learnt_from(spark, monkeypatch):
    """Every document, context and piece counts, and parts side by side tell keys from words as one does."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["the", "tion", "er", "an", "ing"]) for _ in range(7))
    rows = [(i, f"no {i} has {rng.randbytes(16).hex()} and {word()} in it") for i in range(2_600)]
    rows += [(9_000, "x " + "".join(rng.choice("GHJKLMNP") for _ in range(300)) + " y"), (9_001, f"again {rows[0][1][5:]}"), (9_002, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.all_findings(docs)
    by = {(r["y"],): r for r in found.groupBy("y").agg(F.countDistinct("of").alias("n"), F.sum("weight").alias("w")).collect()}
    assert by[1,]["n"] == 2_600 and round(by[1,]["w"]) == 2_600         # beyond any 2,000 a label
    assert by[0,]["n"] == round(by[0,]["w"]) == len({w for _, t in rows for w in secrets.CANDIDATE.findall(t) if not secrets.HEX.search(w)})
    assert found.where("y = 0").groupBy("of").count().agg(F.max("count")).first()[0] >= 6     # pieces of the long one
    assert found.groupBy("of").agg(F.countDistinct("held").alias("k")).where("k > 1").count() == 0
    monkeypatch.setattr(secrets, "PART", 1_200)
    found = secrets.all_findings(docs)
    assert found.select("part").distinct().count() > 3
    net, again = secrets.fit(found, epochs=4), secrets.fit(found.repartition(5), epochs=4)
    assert net.recall >= 0.97 and net.precision >= 0.97 and all((a == b).all() for a, b in zip(net[:5], again[:5]))
