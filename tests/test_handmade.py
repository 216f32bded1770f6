"""Small traces with known answers."""

import random
from datetime import timedelta

import pytest
from driftline.operators import attribution as A
from driftline.operators import checks as C
from driftline.operators import claims as V
from driftline.operators import graph as B
from driftline.operators import normalize as N
from driftline.operators import release as E
from driftline.operators import review as H
from driftline.operators import scoring as G
from driftline.operators import spec as P
from pyspark.sql import functions as F
from traces import ORDINALS, START, got, trace

EXPECTED = list(ORDINALS)
CLEAN = ["signup", "view", "click", "purchase"]


def required(spark):
    return P.mine_fields(trace(spark, {"x": CLEAN}), 1.0)


def test_clean_run_has_no_findings(spark):
    df = trace(spark, {"a": CLEAN})
    spec = P.extract_spec(df, 1.0, 0.0, 1.0)
    assert C.debug_windows(df, spec, ORDINALS, {"k": "immutable"}, {"k": "int"}).count() == 0


@pytest.mark.parametrize("state", [{}, {"k": None}, None])
def test_missing_or_null_field(spark, state):
    df = trace(spark, {"a": ["signup", "view", {"stage": "click", "state": state}, "purchase"]})
    assert got(C.missing_fields(df, required(spark)), "stage", "rule_id") == [("click", "missing_field:click:k")]


def test_skipped_stage(spark):
    df = trace(spark, {"a": ["signup", "click"]})
    assert got(C.skipped_steps(df, ORDINALS), "step", "stage") == [(2, "click")]
    assert got(C.missing_stages(df, EXPECTED), "stage") == [("purchase",), ("view",)]


def test_first_row_may_skip(spark):
    assert got(C.skipped_steps(trace(spark, {"a": ["view"]}), ORDINALS), "stage") == [("view",)]


def test_back_step(spark):
    df = trace(spark, {"a": ["signup", "view", "click", "view"]})
    assert got(C.order_violations(df, ORDINALS), "step") == [(4,)]
    assert C.skipped_steps(df, ORDINALS).count() == 0


def test_bad_updates(spark):
    df = trace(spark, {"a": [{"stage": "view", "state": {"id": i, "n": n}} for i, n in (("x", "1"), (None, "3"), ("y", "2"))]})
    found = got(C.bad_updates(df, {"id": "immutable", "n": "monotone"}), "step", "rule_id")
    assert found == [(3, "immutable_changed:id"), (3, "monotone_fell:n")]


def test_schema_violation_needs_a_value(spark):
    df = trace(spark, {"a": [{"stage": "view", "state": {"n": v}} for v in ("1", "x", None)]})
    assert got(C.schema_violations(df, {"n": "int"}), "step") == [(2,)]


def test_protocol_and_precedence(spark):
    spec = P.extract_spec(trace(spark, {"m": CLEAN}), 1.0)
    df = trace(spark, {"a": ["view", "signup", "click"]})
    assert got(C.protocol_violations(df, spec), "rule_id") == [("protocol:signup:click",), ("protocol:view:signup",)]
    assert got(C.precedence_violations(df, spec), "rule_id") == [("precedence:signup:view",)]


def test_range_violation(spark):
    spec = P.mine_ranges(trace(spark, {"m": [{"stage": "view", "value": float(v)} for v in (1, 2, 3)]}), 0.0, 1.0)
    df = trace(spark, {"a": [{"stage": "view", "value": v} for v in (0.5, 1.0, 3.0, 3.5)]})
    assert got(C.state_violations(df, spec), "step") == [(1,), (4,)]


def support(df, within=None):
    kinds = {"trace": F.col("name") == "click", "diff": F.col("name") == "edit"}
    one = V.check_claims(df, F.col("name") == "purchase", kinds, within)
    two = V.claim_support(V.claims(df, ["purchase"]), V.evidence(df, kinds), within)
    cols = ("session_id", "step_id", "evidence_step_id", "evidence_kind", "status")
    assert got(one, *cols) == got(two, *cols)
    return [r["status"] for r in one.orderBy("session_id", "step_id").collect()]


def test_claim_without_evidence(spark):
    assert support(trace(spark, {"a": ["view", "purchase"], "b": ["click", "purchase"], "c": ["purchase", "click"]})) == [
        "unsupported", "supported", "unsupported"]


def test_evidence_must_be_recent_if_asked(spark):
    df = trace(spark, {"a": ["click", "view", "purchase"]})
    assert support(df, "1 minute") == ["unsupported"] and support(df, "2 minutes") == ["supported"]


def test_evidence_on_the_claims_own_row_does_not_count(spark):
    df = trace(spark, {"a": ["view", "purchase"]})
    out = V.claim_support(V.claims(df, ["purchase"]), V.evidence(df, {"trace": F.col("name") == "purchase"}))
    assert got(out, "status") == [("unsupported",)]


def test_silent_failure(spark):
    df = trace(spark, {"a": CLEAN, "b": CLEAN, "c": ["signup", "error"]})
    told = spark.createDataFrame([("a",), ("b",), ("c",)], "session_id string")
    env = spark.createDataFrame([("a", "open"), ("a", "done"), ("b", "done")], "session_id string, state string")
    verdict = V.false_success(told, env, "session_id", F.col("state") == "done")
    assert got(verdict, "session_id", "status") == [("a", "contradicted"), ("b", "supported"), ("c", "missing")]
    outcome = verdict.select("session_id", (F.col("status") == "supported").alias("good"))
    assert got(V.silent_failures(df, outcome), "session_id") == [("a",)]


def test_citations(spark):
    texts = spark.createDataFrame([
        (1, "so it says: the quick brown\nfox jumps over"), (2, "quick brown fox"), (3, "xquick brown foxy"), (4, "brow"), (5, None)],
        "t bigint, text string")
    passages = spark.createDataFrame([
        (10, "quick brown fox"), (11, "brown\nfox jumps"), (12, "own"), (13, "x j"), (14, ""), (15, "row")], "p bigint, text string")
    found = got(V.cites(texts, passages, "t", "p"), "t", "p")
    want = sorted((t["t"], p["p"]) for t in texts.collect() for p in passages.collect()
                  if t["text"] and p["text"] and p["text"] in t["text"])
    assert found == want and want


def test_citations_by_brute_force(spark, monkeypatch):
    """Passages around the guarantee length, a hot one, equal rows, null and repeated ids, letters of several bytes, a filter that passes all."""
    from driftline.operators import fingerprints
    chance = random.Random(3)
    letter = lambda: chance.choice("ab é\n")
    quotes = ["".join(letter() for _ in range(n)) for n in (1, 2, 3, 8, 15, 16, 17, 30, 31, 32, 33, 34, 60, 200)] + ["a" * 40, "a" * 33, "the hot passage that very many of the texts hold"]
    rows = []
    for k in range(150):
        filler = ["".join(letter() for _ in range(chance.randrange(0, 60))) for _ in range(3)]
        rows.append((k // 2 if k % 9 else None, filler[0] + chance.choice(quotes) + filler[1] + (quotes[-1] if k % 3 == 0 else chance.choice(quotes)) + filler[2]))
    texts = spark.createDataFrame(rows + rows[:10] + [(900, None), (901, "")], "t bigint, text string").repartition(3)
    passages = spark.createDataFrame([*enumerate(quotes), (None, quotes[9]), (50, quotes[-1]), (51, None), (52, "")], "p bigint, text string")
    want = {(t, p) for t, text in rows for p, quote in [*enumerate(quotes), (None, quotes[9]), (50, quotes[-1])] if quote in text}
    for bits in (fingerprints.FILTER_BITS, 8):
        monkeypatch.setattr(fingerprints, "FILTER_BITS", bits)
        found = [tuple(r) for r in V.cites(texts, passages, "t", "p").collect()]
        assert len(found) == len(want) and set(found) == want


def test_few_marks_pass_the_filter(spark):
    from driftline.operators import fingerprints
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    anchors = fingerprints.anchored(spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet"), "item_id")
    marks = fingerprints.candidates(docs, anchors, "doc_id").selectExpr("sum(size(_marks))").first()[0]
    assert 26 <= marks <= 3 * 26


def test_gate_at_the_symptom(spark):
    df = trace(spark, {"a": ["signup", "click", "error"]})
    critical = A.critical_step(C.skipped_steps(df, ORDINALS), B.symptoms(df))
    gates = df.select("session_id", "step_id", "step", F.concat(F.lit("g"), "step").alias("gate"), F.lit(True).alias("passed"))
    assert got(A.missed_gates(gates, critical), "gate") == [("g3",)]
    assert got(A.gate_stats(gates, critical), "gate", "chances", "misses") == [("g3", 1, 1)]


def test_no_deviation_before_the_symptom(spark):
    df = trace(spark, {"a": ["signup", "error", "purchase"]})
    assert A.critical_step(C.skipped_steps(df, ORDINALS), B.symptoms(df)).count() == 0


def test_walk_over_a_cycle_ends(spark):
    edges = spark.createDataFrame([("s", 1, 2), ("s", 2, 1), ("s", 3, 2)], "session_id string, src bigint, dst bigint")
    shown = spark.createDataFrame([("s", 1, 9)], "session_id string, step_id bigint, step int")
    back = B.trace_back(edges, shown, 50)
    assert got(back, "step_id", "depth") == [(1, 0), (2, 1), (3, 2)]


def test_least_depth_wins(spark):
    edges = spark.createDataFrame([("s", 3, 4), ("s", 2, 3), ("s", 1, 2), ("s", 1, 4)], "session_id string, src bigint, dst bigint")
    shown = spark.createDataFrame([("s", 4, 4), ("t", 4, 4)], "session_id string, step_id bigint, step int")
    back = B.trace_back(edges, shown, 5).where("session_id = 's'")
    assert [(r["step_id"], r["path"]) for r in back.orderBy("step_id").collect()] == [(1, [4, 1]), (2, [4, 3, 2]), (3, [4, 3]), (4, [4])]

@pytest.mark.parametrize("depth", [3, None])
def test_long_and_short_sessions_are_walked_alike(spark, monkeypatch, depth):
    """Cycles, repeated edges, unknown steps, two symptoms of a session; against a plain search for the least path."""
    chance = random.Random(6)
    edges = [(s, chance.randrange(9), chance.randrange(9)) for s in "abcd" for _ in range(chance.randrange(4, 14))]
    shown = [(s, k, 7) for s in "abcde" for k in (2, 5)] + [("a", 2, 3), (None, 1, 1), ("b", None, 1)]
    want = set()
    for s, symptom in {(s, k) for s, k, _ in shown if s and k}:
        best, front, far = {symptom: (symptom,)}, [(symptom,)], 0
        while front and (depth is None or far < depth):
            far += 1
            ways = sorted((*w, a) for w in front for t, a, b in edges if t == s and b == w[-1])
            front = [w for i, w in enumerate(ways) if w[-1] not in best and w[-1] not in {v[-1] for v in ways[:i]}]
            best.update({w[-1]: w for w in front})
        want |= {(s, symptom, 3 if (s, symptom) == ("a", 2) else 7, step, len(w) - 1, w) for step, w in best.items()}
    edges_df = spark.createDataFrame(edges + edges[:3] + [("a", None, 2)], "session_id string, src bigint, dst bigint")
    shown_df = spark.createDataFrame(shown, "session_id string, step_id bigint, step int")
    for most in (B.LOCAL_EDGES, 8, 0):
        monkeypatch.setattr(B, "LOCAL_EDGES", most)
        found = [(*r[:5], tuple(r["path"])) for r in B.trace_back(edges_df, shown_df, depth).select("session_id", "symptom_id", "symptom_step", "step_id", "depth", "path").collect()]
        assert len(found) == len(want) and set(found) == want
    assert B.trace_back(edges_df, shown_df.limit(0), depth).count() == 0


def test_graph_edges(spark):
    rows = [{"stage": "view", "artifact_id": "f", "rw": rw} for rw in ("w", "r", "w", "r")]
    _, edges = B.build_graph(trace(spark, {"a": rows}))
    assert got(edges.where("edge_kind = 'artifact'"), "src", "dst") == [(1, 2), (3, 4)]
    assert edges.where("edge_kind = 'next'").count() == 3


def test_propagation_joins_equal_neighbours(spark):
    df = trace(spark, {"a": ["view", "view", "click", "error"]})
    nodes, edges = B.build_graph(df)
    chains = B.propagation(B.trace_back(edges, B.symptoms(df), 5), nodes)
    assert chains.where("depth = 3").first()["stages"] == ["view", "click", "error"]


def test_gap_of_exactly_g_is_one_session(spark):
    rows = spark.createDataFrame([("u", START + timedelta(hours=h), i) for i, h in enumerate((0, 24, 49))],
                                 "owner string, ts timestamp, step_id bigint")
    assert got(N.sessionize(rows, "owner", "24 hours"), "step_id", "session_id") == [(0, "u-1"), (1, "u-1"), (2, "u-2")]


def test_windows_end_at_their_marker(spark):
    df = trace(spark, {"a": ["view", "signup", "click", "purchase", "view", "signup", "view"]})
    cut = N.skill_windows(df, F.col("name") == "signup", F.col("name") == "purchase")
    assert got(cut, "window_id", "step") == [(1, 2), (1, 3), (1, 4), (2, 6), (2, 7)]


def test_first_report_is_kept(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 1, "c")], "event_id bigint, ts bigint, x string")
    assert got(N.dedup_events(df, ["event_id"], ["ts"]), "event_id", "x") == [(1, "a"), (2, "c")]


def test_completeness(spark):
    df = trace(spark, {"a": CLEAN}).where("step <> 2")
    assert got(N.completeness(df, ["purchase"]), "n_rows", "missing_steps", "present", "ended") == [(3, 1, 0.75, True)]


def test_progress(spark):
    df = trace(spark, {"a": ["signup", "click", "view", "click", "error", "purchase"]})
    assert [r["progress"] for r in G.progress_steps(df, ORDINALS).orderBy("step").collect()] == [1, 1, -1, 0, 0, 1]


def test_insufficient_verdict(spark):
    auto = spark.createDataFrame([("f", "x", True), ("g", "y", True), ("h", "z", False)], "finding_id string, cause string, flagged boolean")
    verdicts = spark.createDataFrame(
        [("f", "confirm", None, "e", 1), ("f", "insufficient", None, "e", 2), ("g", "correct", "w", "e", 1)],
        "finding_id string, verdict string, cause string, reviewer string, round int")
    done = H.resolve(auto, verdicts, ["finding_id"], ["round"])
    assert got(done, "finding_id", "verdict") == [("f", "insufficient"), ("g", "correct"), ("h", "unreviewed")]
    assert {r["finding_id"]: r["cause"] for r in done.collect()} == {"f": None, "g": "w", "h": "z"}
    labels = spark.createDataFrame([("f", None), ("g", True)], "finding_id string, bad boolean")
    counts = H.label_accuracy(auto, labels, "finding_id").first()
    assert (counts["tp"], counts["fp"], counts["insufficient"], counts["unreviewed"]) == (1, 0, 1, 1)


def test_version_against_itself(spark):
    runs = spark.createDataFrame([("a", True, 1.0), ("b", False, 0.0)], "case_id string, passed boolean, score double")
    gate = E.release_gate(runs, runs, {"pass_rate": 0.5}).first()
    assert gate["accepted"] and gate["regressions"] == 0 and E.case_diff(runs, runs).count() == 0


def test_regression_blocks_release(spark):
    base = spark.createDataFrame([("a", True, 1.0), ("b", False, 0.0)], "case_id string, passed boolean, score double")
    cand = spark.createDataFrame([("a", False, 0.0), ("b", True, 1.0), ("c", True, 1.0)], base.schema)
    gate = E.release_gate(base, cand, {"pass_rate": 0.5}).first()
    assert gate["floors_met"] and not gate["accepted"]
    assert got(E.case_diff(base, cand), "case_id", "change") == [("a", "regressed"), ("b", "fixed"), ("c", "new")]


def test_votes(spark):
    ballots = spark.createDataFrame(
        [("a", "r1", "confirm"), ("a", "r2", "confirm"), ("a", "r3", "correct"), ("b", "r1", "confirm"), ("b", "r2", "correct")],
        "finding_id string, reviewer string, verdict string")
    assert got(A.vote(ballots, 2), "finding_id", "decision") == [("a", "confirm"), ("b", "split")]


def test_sets_are_disjoint_and_stable(spark):
    cases = spark.range(200).select(F.col("id").cast("string").alias("case_id"))
    hard = cases.where("cast(case_id as int) < 50").union(cases.where("case_id = '3'"))
    sets = E.assign_sets(cases, hard)
    assert sets.count() == 200 and got(sets.groupBy("set_name").count(), "set_name", "count") == [("golden", 150), ("hard", 50)]
    again = E.assign_sets(cases.repartition(7), hard)
    assert got(sets, "case_id", "split") == got(again, "case_id", "split")


def test_evidence_references(spark):
    df = trace(spark, {"a": ["view", "click", "click", "error"]})
    kinds = {"trace": F.col("name") == "click", "command": F.col("name") == "view"}
    found = V.attach_evidence(df.where("name = 'error'").select("session_id", "step_id", "step"), V.evidence(df, kinds)).first()
    assert [(e["kind"], e["step_id"]) for e in found["evidence"]] == [("command", 1), ("trace", 3)]


def test_assertions_count_undecided(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    assert got(E.assertions(df, {"big": "n > 3"}), "assertion", "passed", "failed", "undecided") == [("big", 1, 1, 1)]


def test_empty_trace(spark):
    df = trace(spark, {"a": CLEAN}).where("false")
    spec = P.extract_spec(df, 0.5)
    assert spec.count() == 0
    assert C.debug_windows(df, spec, ORDINALS).count() == 0
    assert G.trajectory_anomaly(df).count() == 0


def test_moves_are_ruled_only_where_rules_speak(spark):
    df = trace(spark, {"a": ["signup", "view", "click"], "b": ["signup", "click", "view"]}).withColumn("skill", F.when(F.col("session_id") == "a", "A").otherwise("B"))
    rules = "skill string, rule_id string, rule_kind string, stage string, before string, field string, lo double, hi double"
    one = spark.createDataFrame([("A", "r", "transition", "click", "signup", None, None, None)], rules)
    assert [(r["session_id"], r["rule_id"]) for r in C.protocol_violations(df, one).collect()] == [("a", "protocol:signup:view")]
    none = spark.createDataFrame([("A", "r", "range", "view", None, None, 0.0, 1e9)], rules)
    assert C.protocol_violations(df, none).count() == C.protocol_violations(df, one.limit(0)).count() == 0


def test_cases_left_open_are_told(spark):
    rows = lambda got: spark.createDataFrame([(k, v, 1.0) for k, v in got.items()], "case_id string, passed boolean, score double")
    base = rows({"a": True, "b": True, "c": False, "d": None, "e": None, "f": True, "g": False})
    cand = rows({"a": False, "b": None, "c": None, "d": True, "e": None, "f": True, "h": True})
    found = {r["case_id"]: r["change"] for r in E.case_diff(base, cand).collect()}
    assert found == {"a": "regressed", "b": "undecided", "c": "reopened", "d": "settled", "g": "gone", "h": "new"}
    gate = E.release_gate(base, cand, {}).first()
    assert gate["regressions"] == sum(v in ("regressed", "undecided") for v in found.values())


def test_a_reliable_minority_outvotes_a_noisy_majority(spark):
    """Two verifiers that are nearly always right, three that guess; repeated votes, odd verdicts, and a finding with one vote."""
    from driftline.operators import consensus
    chance = random.Random(1)
    truth = {f"f{k:03d}": chance.choice(["confirm", "correct"]) for k in range(400)}
    other = {"confirm": "correct", "correct": "confirm"}
    rows = [(f, who, t if chance.random() < 0.97 else other[t]) for f, t in truth.items() for who in ("sure-a", "sure-b")]
    rows += [(f, who, chance.choice(["confirm", "correct"])) for f in truth for who in ("dice-a", "dice-b", "dice-c")]
    for f in ("f000", "f001"):
        rows = [r for r in rows if r[0] != f] + [(f, w, truth[f]) for w in ("sure-a", "sure-b")] + [(f, f"dice-{c}", other[truth[f]]) for c in "abc"]
    given = spark.createDataFrame(rows + rows[:50] + [("one", "sure-a", "insufficient"), (None, "sure-a", "confirm"), ("f000", None, "confirm"), ("none", "sure-a", "maybe")],
                                  "finding_id string, reviewer string, verdict string")
    found, rates = consensus.weighed_votes(given)
    found = {r["finding_id"]: r for r in found.collect()}
    assert set(found) == {*truth, "one"} and found["one"]["n_votes"] == 1
    assert found["f000"]["decision"] == truth["f000"] and found["f001"]["decision"] == truth["f001"] and found["f000"]["n_votes"] == 5
    assert A.vote(given, 3).where("finding_id = 'f001'").first()["decision"] == other[truth["f001"]]
    assert sum(found[f]["decision"] == t for f, t in truth.items()) >= 0.95 * len(truth)
    right = {r["reviewer"]: r["rate"] for r in rates.where("truth = 'confirm' AND verdict = 'confirm'").collect()}
    assert min(right["sure-a"], right["sure-b"]) > 0.9 and max(right[f"dice-{c}"] for c in "abc") < 0.7
    empty, _ = consensus.weighed_votes(given.limit(0))
    assert empty.count() == 0


def test_contexts_see_what_single_moves_do_not(spark):
    """Every run goes round three stages one way; one goes round by moves that are each as common, in an order no other takes."""
    usual = ["view", "click", "view", "purchase"] * 8
    odd = ["view", "click", "view", "click"] * 4 + ["view", "purchase", "view", "purchase"] * 4
    df = trace(spark, {**{f"s{k:02d}": usual for k in range(30)}, "odd": odd})
    near = G.trajectory_surprise(df).groupBy().agg(F.max("surprise") - F.min("surprise")).first()[0]
    far = G.context_anomaly(df, 3, 1.0).orderBy(F.desc("surprise")).collect()
    assert near < 0.02 and far[0]["session_id"] == "odd" and far[0]["surprise"] > 10 * far[1]["surprise"]
    one = {r["session_id"]: round(r["surprise"], 9) for r in G.context_surprise(df, 1).collect()}
    assert one == {r["session_id"]: round(r["surprise"], 9) for r in G.trajectory_surprise(df).collect()}


def test_unknown_stages_end_a_context(spark, cut_groups):
    df = trace(spark, {"a": ["view", {"stage": None}, "click", "view", "click"], "b": ["view"]})
    tree = {(tuple(r["context"]), r["stage"]): r["n"] for r in G.context_tree(df, 3, -1e9).collect()}
    assert tree == {(("view",), None): 1, (("click",), "view"): 1, (("view",), "click"): 1, (("view", "click"), "click"): 1}
    assert G.context_tree(df.limit(0)).count() == 0
