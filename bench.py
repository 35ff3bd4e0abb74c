"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_RUNS the timed runs
per query (the median counts), BENCH_QUERIES a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from keyloom.plans.star import QUERIES
from keyloom.session import local_session

HEADLINE = (
    "A1_usage_rollup",
    "A2_readiness",
    "A5_dup_report",
    "A6_fill_profile",
    "A10_duplicate_count",
    "J1_inner_join",
    "J2_snowflake",
    "J5_next_match",
    "J6_latest_per_key",
    "J10_exists_flags",
    "J11_null_safe_join",
    "J12_new_keys",
    "F1_settlement",
    "W1_priority_pick",
    "W1_priority_flags",
    "W2_dedupe",
    "W4_row_number",
    "D3_keep_latest",
    "X14_clean_digits",
    "X16_document_mails",
    "X17_script_fallback",
    "X18_bullets",
    "L1_guarded_upsert",
    "L2_overwrite_upsert",
    "L3_exact_upsert",
    "L4_insert_only",
    "L6_changes",
    "V1_issues",
    "V7_audit_events",
)


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores, shuffle_partitions=max(8, int(cores)))
    seconds = {}
    for name in names:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
