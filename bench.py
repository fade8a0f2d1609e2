"""Time the headline queries and print one JSON line.

Each query runs once to warm up and once timed, writing every row and column to
the ``noop`` sink. A query that fails is named under ``failed`` and has no time.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assetloom.registry import QUERIES  # noqa: E402
from assetloom.session import build_session  # noqa: E402

HEADLINE = (
    "pending_cuts", "pending_docs", "keyword_filter", "inventory_labels", "stable_rows",
    "claim_listed", "listed_orders", "size_reconcile", "latest_state", "transitions",
    "upsert_customers", "insert_ignore", "all_claims", "ledger_health", "failure_ratio",
    "format_table", "page_marks", "topk_per_group", "renumber", "rename_plan", "name_suffixes",
    "safe_names", "url_parts", "discovery_ingest", "probe_facts", "best_moments", "segment_plan",
    "line_manifest", "playlist_segments", "log_progress", "error_report", "retry_decision",
    "run_outcomes", "scene_plan", "transfer_eligibility", "stream_counts", "stream_stable",
    "stream_links", "stream_upserts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("assetloom-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds, failed = {}, {}
    for name in names:
        try:
            for _ in range(2):
                began = time.perf_counter()
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                seconds[name] = round(time.perf_counter() - began, 3)
        except Exception as error:  # the others are still worth measuring
            seconds.pop(name, None)
            failed[name] = f"{type(error).__name__}: {error}"[:200]
    with contextlib.redirect_stdout(sys.stderr):
        spark.stop()
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "failed": failed, "sf": os.path.basename(folder).removeprefix("sf")}))


if __name__ == "__main__":
    main()
