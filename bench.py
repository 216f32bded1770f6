"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from driftline.plans import catalog  # noqa: E402
from driftline.session import local_session  # noqa: E402

HEADLINE = [
    "n4_sessionize", "n3_assign_levels", "w1_skill_windows", "v3_claim_support", "v4_false_success", "v5_silent_failures",
    "v7_cites", "p3_mine_order", "p4_mine_ranges", "p5_mine_transitions", "c1_missing_fields", "c4_skipped_steps",
    "c9_debug", "c10_path_distance", "g1_output_scores", "g2_progress_scores", "g4_trajectory_anomaly", "g5_level_rollup",
    "a1_build_graph", "a4_trace_back", "a6_critical_step", "a7_candidate_causes", "a8_missed_gates", "a10_event_impact",
    "a15_attribution_report", "h2_resolve", "h5_dispositions", "e4_offline_eval", "e5_release_gate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    names = list(catalog.QUERIES) if wanted == ["all"] else wanted
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
