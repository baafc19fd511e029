"""Headline queries over one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs once after a warm-up read, writing to the no-op sink so that every row is computed.
"""

from __future__ import annotations

import json
import os
import re
import time

from runlens.plans import catalog
from runlens.session import local_session

HEADLINE = [
    "fold_outcomes",
    "unfold_outcomes",
    "pair_states",
    "flipped_tests",
    "clone_classes",
    "filter_chain",
    "agreement",
    "single_test_status",
    "test_status_anchored",
    "time_prediction",
    "time_hotspot",
    "merge_passes",
    "hot_truth",
    "value_tables",
    "build_samples",
    "exclusive_cost",
    "function_summary",
    "segment_tests",
    "match_trace_test",
    "score_hot",
    "leaderboard",
    "triage_run",
    "enrich_predictions",
    "commit_at_step",
    "verify_golden",
    "normalize_patch",
    "diff_fingerprint",
    "parse_responses",
    "slice_sources",
    "oracle_context",
    "sample_instances",
    "stream_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, cores, "runlens-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    queries, seconds = catalog.queries(), {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
