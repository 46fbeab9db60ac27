"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query is run
once for warm-up (`cold`) and then BENCH_RUNS times; the median counts. Results
go to a no-op sink, so every row and column is produced and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larkspur.catalog import QUERIES  # noqa: E402
from larkspur.session import local_session  # noqa: E402

HEADLINE = [
    "gap_report", "version_stats", "make_frames", "gate_accept", "score_distribution",
    "acceptance_by_class", "gate_panels", "collect_training_items", "stratified_split",
    "leakage_check", "truncate_tokens", "render_chat", "load_pairs_csv", "best_attempt",
    "filter_and_topup", "quota_sample", "setting_table", "allocate_budget", "work_orders",
    "round_history", "extract_metrics", "probe_markers", "console_tail", "status_transitions",
    "last_scalar", "nn_score", "mine_similar", "class_report", "lineage", "resolve_by_tag",
    "champion", "publish_version", "mirror_log_stream",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "16g")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold, warm = {}, {}
    for name in names:
        cold[name] = once(name)
        warm[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(sf.rstrip("/")), "cpus": cpus}))


if __name__ == "__main__":
    main()
