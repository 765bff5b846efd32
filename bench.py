"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the
threads. Every query runs once to warm up plans and code and once for the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.registry import queries  # noqa: E402
from journeylake.session import build_session  # noqa: E402

HEADLINE = (
    "funnel_metrics", "rejection_analysis", "engagement_stats", "engagement_pivot", "conversion_scores",
    "segment_summary", "raw_engagement_scores", "stage_send_summary", "missed_sends", "outbound_reconciliation",
    "outbound_engagement", "dash_segments", "intake_trend_month", "validate_leads", "resolve_identity",
    "master_prospects", "scd2_silver", "merge_upsert", "assign_keys", "first_per_key", "dim_prospect",
    "fact_engagement", "journey_mart_summary", "prospect_360_features", "similar_embeddings",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    cold, warm = {}, {}
    for name in HEADLINE:
        for times in (cold, warm):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
