"""Outer schemas of the canonical tables. State stays a map, so absent differs from null."""

EVIDENCE = "array<struct<session_id:string,step_id:bigint,kind:string>>"

TRACE = (
    "session_id string, task_id string, stage string, step_id bigint, step int, ts timestamp, layer string, "
    "kind string, name string, skill string, artifact_id string, rw string, state map<string,string>, "
    "value double, ok boolean, version string"
)
SPEC = (
    "skill string, rule_id string, rule_kind string, stage string, before string, field string, "
    "lo double, hi double, support double"
)
FEEDBACK = "session_id string, step_id bigint, problem string, ts timestamp"
VERDICTS = "session_id string, finding_id string, reviewer string, verdict string, cause string, ts timestamp"
FINDINGS = (
    "session_id string, step_id bigint, step int, stage string, skill string, rule_id string, "
    f"rule_kind string, severity double, evidence {EVIDENCE}"
)
REPORTS = (
    "session_id string, first_step_id bigint, cause string, gate string, symptoms bigint, sentence string"
)
GATES = "session_id string, step_id bigint, step int, gate string, passed boolean"
PROOFS = "session_id string, step_id bigint, step int, ts timestamp, evidence_kind string"
RESULTS = "case_id string, version string, passed boolean, score double"
LEDGER = "version string, decision string, decided_by string, ts timestamp"
ROUTING = "cause string, target string"
ADVICE = "rule_kind string, advice string"
VOTES = "finding_id string, reviewer string, verdict string"
EVALSET = "case_id string, set_name string, split string, expected string"
