"""Times the headline queries and prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query is built and fully computed, without collecting rows, twice; the
better time counts, so start-up of the JVM is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from shelfscout.session import local_session
from testbed.queries import REGISTRY

HEADLINE = (
    "sales_rollup",
    "store_recent_sales",
    "latest_attributes",
    "stage_accounts",
    "stage_opportunities",
    "dedup_snapshots",
    "accounts_current",
    "primary_contact",
    "match_flag",
    "top_targets",
    "target_mart",
    "match_coverage",
    "parse_failures",
    "duplicates_agree",
    "category_classify",
    "market_trend",
    "check_suite",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 8)))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores=cpus, shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
