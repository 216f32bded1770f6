"""Comparing runs with their rules: every function returns rows of findings.

Checks on single rows share one pass: each brings the running columns it needs and the
deviations it sees in a row as an array, and ``_scan`` puts them together. A stage's rules
travel as one row, so rows meet them by a join on the stage that neither multiplies nor,
while the rules are few, shuffles them. Rules that name a skill hold for its rows only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import lookup, ordinal_of
from driftline.functions.ordered import SEG, Run, carried, last_known, previous, run_key, running, running_max, session_key
from driftline.functions.sizing import small_side
from driftline.operators.sequences import lacking

# Weight of a deviation by its kind.
SEVERITY = {
    "missing_field": 0.4,
    "immutable_changed": 0.6,
    "monotone_fell": 0.5,
    "missing_stage": 0.5,
    "skipped_step": 0.5,
    "wrong_order": 0.3,
    "precedence": 0.3,
    "out_of_range": 0.2,
    "protocol": 0.2,
    "bad_type": 0.4,
    "sequence": 0.5,
}


@dataclass(frozen=True)
class RowCheck:
    """Deviations seen in a row (``hits``), with the columns they look at."""

    hits: Column
    ruled: bool = False
    added: dict[str, Column] = field(default_factory=dict)
    runs: dict[str, Run] = field(default_factory=dict)


def _hit(kind: str, *subject: Column | str) -> Column:
    parts = [F.lit(s) if isinstance(s, str) else s for s in subject]
    return F.struct(F.lit(kind).alias("kind"), F.concat_ws(":", F.lit(kind), *parts).alias("rule"))


def _one(broken: Column, kind: str, *subject: Column | str) -> Column:
    return F.array(F.when(broken, _hit(kind, *subject)))


def has_skill(df: DataFrame) -> Column:
    """The skill a row belongs to, null where rows name none."""
    return F.col("skill") if "skill" in df.columns else F.lit(None).cast("string")


def ruled(rows: DataFrame, spec: DataFrame, moves: bool = False) -> DataFrame:
    """Rows with what their stage asks for: required fields, ranges, the stages it may follow, and with ``moves`` out of which stages moves are ruled at all.

    Rules of a skill hold for its rows, rules without one for all. Each set travels as one row per stage, the last one as one row per skill.
    """
    kind = F.col("rule_kind")
    rules = spec.where(kind.isin("required_field", "range", "transition")).groupBy(
        F.col("skill").alias("_skill"), F.col("stage").alias("_stage")).agg(
        F.collect_set(F.when(kind == "required_field", F.col("field"))).alias("required"),
        F.collect_set(F.when(kind == "range", F.struct("rule_id", "lo", "hi"))).alias("ranges"),
        F.collect_set(F.when(kind == "transition", F.col("before"))).alias("allowed"))
    rules = small_side(rules)
    asked = F.struct("required", "ranges", "allowed")
    rows = rows.join(rules.where("_skill IS NULL").select("_stage", asked.alias("_for_all")), F.col("stage") == F.col("_stage"), "left").drop("_stage")
    parts = ["_for_all"]
    if "skill" in rows.columns:
        own = rules.where("_skill IS NOT NULL").select("_skill", "_stage", asked.alias("_own"))
        rows = rows.join(own, (F.col("stage") == F.col("_stage")) & (F.col("skill") == F.col("_skill")), "left").drop("_stage", "_skill")
        parts.append("_own")

    def put_together(name: str, kind: str, parts: list[str] = parts) -> Column:
        return F.array_distinct(F.concat(*[F.coalesce(f"{p}.{name}", F.array().cast(kind)) for p in parts]))

    if moves:
        ways = spec.where(kind == "transition")
        ruled_from = F.collect_set("before").alias("from")
        # One row, also without such rules.
        rows = rows.join(F.broadcast(ways.where("skill IS NULL").agg(ruled_from).select(F.struct("from").alias("_from_all"))))
        sources = ["_from_all"]
        if "skill" in rows.columns:
            own_ways = small_side(ways.where("skill IS NOT NULL").groupBy(F.col("skill").alias("_skill")).agg(ruled_from).select("_skill", F.struct("from").alias("_from_own")))
            rows = rows.join(own_ways, F.col("skill") == F.col("_skill"), "left").drop("_skill")
            sources.append("_from_own")
        rows = rows.withColumn("_ruled_from", put_together("from", "array<string>", sources)).drop(*sources)
    return rows.withColumns({
        "_required": F.array_sort(put_together("required", "array<string>")),
        "_ranges": put_together("ranges", "array<struct<rule_id:string,lo:double,hi:double>>"),
        "_allowed": put_together("allowed", "array<string>")})


def _scan(df: DataFrame, checks: list[RowCheck], spec: DataFrame | None = None) -> DataFrame:
    """All given checks in one pass over the rows."""
    rows = df.withColumns({n: c for check in checks for n, c in check.added.items()})
    runs = {n: r for check in checks for n, r in check.runs.items()}
    by_session = {n: r for n, r in runs.items() if n.startswith("_was_")}
    by_run = {n: r for n, r in runs.items() if n not in by_session}
    if by_run:
        rows = running(rows, by_run, key=run_key(df))
    if by_session:
        rows = running(rows, by_session, key=session_key(df))
    if any(check.ruled for check in checks):
        rows = ruled(rows, spec, "_before" in runs)
    hits = F.array_compact(F.concat(*[check.hits for check in checks]))
    found = rows.select(*carried(df), "step_id", "step", "stage", has_skill(df).alias("skill"), F.explode(hits).alias("_hit"))
    return _findings(found, F.col("_hit.kind"), F.col("_hit.rule"))


def _findings(df: DataFrame, kind: Column, rule: Column) -> DataFrame:
    return df.select(
        *carried(df), "step_id", F.col("step").cast("int").alias("step"), "stage", has_skill(df).alias("skill"),
        rule.alias("rule_id"), kind.alias("rule_kind"), lookup(SEVERITY)[kind].alias("severity"))


def _check_fields() -> RowCheck:
    state = F.coalesce("state", F.create_map().cast("map<string,string>"))
    held = F.map_keys(F.map_filter(state, lambda _, v: v.isNotNull()))
    absent = F.array_except("_required", held)
    return RowCheck(F.transform(absent, lambda f: _hit("missing_field", F.col("stage"), f)), ruled=True)


def _check_range() -> RowCheck:
    outside = F.exists("_ranges", lambda r: (F.col("value") < r["lo"]) | (F.col("value") > r["hi"]))
    return RowCheck(_one(outside, "out_of_range", F.col("stage")), ruled=True)


def _check_transition() -> RowCheck:
    before = F.col("_before")
    known = F.coalesce(F.array_contains("_allowed", before), F.lit(False))
    spoken_of = F.array_contains("_ruled_from", before)         # no rule out of a stage: every way out is open
    return RowCheck(_one(before.isNotNull() & spoken_of & ~known, "protocol", before, F.col("stage")), ruled=True,
                    runs={"_before": previous("stage")})


def _check_place(ordinals: dict[str, int], *kinds: str) -> RowCheck:
    here, peak = F.col("_ord"), F.col("_peak")
    broken = {"skipped_step": here > F.coalesce(peak, F.lit(0)) + 1, "wrong_order": here < peak}
    hits = F.concat(*[_one(broken[k], k, F.col("stage")) for k in kinds])
    return RowCheck(hits, added={"_ord": ordinal_of("stage", ordinals)}, runs={"_peak": running_max("_ord")})


def _check_updates(policy: dict[str, str]) -> RowCheck:
    hits = []
    for name, rule in policy.items():
        now, was = F.col("state")[name], F.col(f"_was_{name}")
        if rule == "immutable":
            hits.append(_one(now != was, "immutable_changed", name))
        elif rule == "monotone":
            hits.append(_one(now.try_cast("double") < was.try_cast("double"), "monotone_fell", name))
        else:
            raise ValueError(f"unknown update policy: {rule}")
    return RowCheck(F.concat(*hits), runs={f"_was_{n}": last_known(F.col("state")[n]) for n in policy})


def _check_types(types: dict[str, str]) -> RowCheck:
    return RowCheck(F.concat(*[
        _one(F.col("state")[n].isNotNull() & F.col("state")[n].try_cast(t).isNull(), "bad_type", n) for n, t in types.items()]))


def missing_fields(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Required fields absent or null in a row that reached their stage."""
    return _scan(df, [_check_fields()], spec)


def state_violations(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Values outside the range mined for their stage."""
    return _scan(df, [_check_range()], spec)


def protocol_violations(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Transitions that are not among the allowed ones, out of stages for which the row's skill, or all, have transition rules."""
    return _scan(df, [_check_transition()], spec)


def skipped_steps(df: DataFrame, ordinals: dict[str, int]) -> DataFrame:
    """Rows whose stage lies more than one beyond the furthest stage before them."""
    return _scan(df, [_check_place(ordinals, "skipped_step")])


def order_violations(df: DataFrame, ordinals: dict[str, int]) -> DataFrame:
    """Rows behind the furthest stage before them; see also ``precedence_violations``."""
    return _scan(df, [_check_place(ordinals, "wrong_order")])


def place_violations(df: DataFrame, ordinals: dict[str, int]) -> DataFrame:
    """Skipped and misordered steps in one pass."""
    return _scan(df, [_check_place(ordinals, "skipped_step", "wrong_order")])


def bad_updates(df: DataFrame, policy: dict[str, str]) -> DataFrame:
    """Fields declared ``immutable`` that changed, or ``monotone`` that fell, against their last value in the session."""
    return _scan(df, [_check_updates(policy)])


def schema_violations(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """State fields that cannot be read as their declared type."""
    return _scan(df, [_check_types(types)])


def missing_stages(df: DataFrame, expected: list[str] | DataFrame) -> DataFrame:
    """Expected stages a session (or window) never reached; given as a list or as a spec table.

    A rule that names a skill asks its stage of runs with rows of that skill.
    """
    key = run_key(df)
    if isinstance(expected, DataFrame):
        rules = expected.where("rule_kind = 'mandatory_stage'")
        for_all = rules.where("skill IS NULL").agg(F.array_sort(F.collect_set("stage")).alias("s")).scalar()
        own = rules.where("skill IS NOT NULL").groupBy("skill").agg(F.collect_set("stage").alias("s"))
        own = own.agg(F.map_from_entries(F.collect_list(F.struct("skill", "s"))).alias("m")).scalar()
        seen = df.groupBy(*key).agg(F.collect_set("stage").alias("_seen"), F.collect_set(has_skill(df)).alias("_skills"))
        seen = seen.withColumn("_asked", own)
        none = F.array().cast("array<string>")
        wanted = F.array_union(for_all, F.flatten(F.transform("_skills", lambda k: F.coalesce(F.col("_asked")[k], none))))
    else:
        wanted = F.array(*map(F.lit, expected))
        reached = F.when(F.col("stage").isin(expected), F.col("stage"))
        seen = df.groupBy(*key).agg(F.collect_set(reached).alias("_seen"))
    lost = seen.withColumn("_wanted", wanted).select(*key, F.explode(F.array_except("_wanted", "_seen")).alias("stage"))
    lost = lost.withColumns({"step_id": F.lit(None).cast("bigint"), "step": F.lit(None).cast("int")})
    return _findings(lost, F.lit("missing_stage"), F.concat_ws(":", F.lit("missing_stage"), "stage"))


def precedence_violations(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Runs that first reach ``stage`` ahead of their first ``before``, though they reach both.

    A first visit meets the rules that name its stage on either side, and a rule's two sides meet in an aggregate, so
    nothing grows with the number of other stages. A rule that names a skill compares first visits in rows of that skill.
    """
    key = run_key(df)
    visits = df.groupBy(*key, "stage", has_skill(df).alias("_skill")).agg(F.min(F.struct("step", "step_id")).alias("_at"))
    rules = spec.where("rule_kind = 'precedence'").select("skill", "stage", "before").distinct()
    sides = rules.select(F.struct("skill", "before", "stage").alias("_rule"), F.inline(F.array(*[
        F.struct(F.col(c).alias("_side"), F.lit(c == "stage").alias("_later")) for c in ("before", "stage")])))
    met = visits.join(small_side(sides), (F.col("stage") == F.col("_side")) & (F.col("_rule.skill").isNull() | (F.col("_rule.skill") == F.col("_skill"))))
    later = F.col("_later")
    turned = met.groupBy(*key, "_rule").agg(F.min(F.when(~later, F.col("_at"))).alias("_before"), F.min(F.when(later, F.col("_at"))).alias("_at"))
    turned = turned.where(F.col("_before") > F.col("_at")).select(
        *key, F.col("_rule.stage").alias("stage"), F.col("_rule.before").alias("before"), F.col("_rule.skill").alias("skill"), "_at.step", "_at.step_id")
    return _findings(turned, F.lit("precedence"), F.concat_ws(":", F.lit("precedence"), "before", "stage"))


def sequence_violations(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Runs that do not hold a sequence of stages they should; a rule that names a skill asks the rows of that skill, of runs that have some."""
    rules = spec.where("rule_kind = 'sequence'").select("skill", F.concat_ws(">", "before", "stage").alias("q")).distinct().collect()    # rules are few
    found = None
    for skill in sorted({r["skill"] for r in rules}, key=str):
        rows = df if skill is None else df.where(F.col("skill") == skill) if "skill" in df.columns else df.limit(0)
        own = lacking(rows, sorted(tuple(r["q"].split(">")) for r in rules if r["skill"] == skill)).withColumn("skill", F.lit(skill).cast("string"))
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = lacking(df.limit(0), []).withColumn("skill", F.lit(None).cast("string"))
    found = found.withColumns({"stage": F.substring_index("sequence", ">", -1), "step_id": F.lit(None).cast("bigint"), "step": F.lit(None).cast("int")})
    return _findings(found, F.lit("sequence"), F.concat_ws(":", F.lit("sequence"), "sequence"))


def debug_windows(df: DataFrame, spec: DataFrame, ordinals: dict[str, int] | None = None,
                  policy: dict[str, str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """Every deviation of the given rows from their rules in one table of findings.

    One pass finds what single rows show, two aggregates what whole runs lack or turn round; sequences are looked for if there are rules of this kind.
    Pass the spec settled or read from a file: several steps look at it.
    """
    checks = [_check_fields(), _check_range(), _check_transition()]
    if ordinals:
        checks.append(_check_place(ordinals, "skipped_step", "wrong_order"))
    if policy:
        checks.append(_check_updates(policy))
    if types:
        checks.append(_check_types(types))
    found = _scan(df, checks, spec)
    whole = precedence_violations(df, spec).unionByName(missing_stages(df, spec))
    if not spec.where("rule_kind = 'sequence'").isEmpty():
        whole = whole.unionByName(sequence_violations(df, spec))
    # Findings on whole runs name no piece; they get the first.
    return found.unionByName(whole.withColumn(SEG, F.lit(0)) if SEG in found.columns else whole)
