"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then twice; the faster run counts. Results go to the noop
sink, so all columns are computed. Queries that write tables run once.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES, configured
from spanledger.session import local_session

READS = (
    "progress",
    "history_summary",
    "latest_state",
    "latest_txs",
    "find_gaps",
    "continuous_ranges",
    "coverage_segments",
    "range_summary",
    "repair_plan_maintain",
    "repair_plan_auto",
    "validate_timestamps",
    "rows_per_range",
    "block_islands",
    "enrich_strict",
    "missing_parents",
    "explode_withdrawals",
    "clean_documents",
    "hex_pages",
    "detect_reorg",
    "duration_histogram",
)
WRITES = ("append_versioned", "delete_range", "replace_ranges", "expire_live", "historical_state", "stream_dedup")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")

    def run(name: str) -> float:
        began = time.perf_counter()
        configured(QUERIES[name])(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in READS:
        run(name)
        seconds[name] = round(min(run(name), run(name)), 3)
    for name in WRITES:
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
