"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS     cores of local[N]      (default 8)
BENCH_RUNS     timed runs per query   (default 3, the median counts)
BENCH_QUERIES  comma-separated names  (default: the list below)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.plans.queries import QUERIES  # noqa: E402
from changeflow.session import local_session  # noqa: E402

HEADLINE = [
    "flagship", "last_op_per_key", "merge_round", "change_rows", "cdf_messages", "state_current", "upsert_view",
    "cdf_stream", "front_matter", "reports_parsed", "sections",
    "chunks", "point_ids", "conclusions_valid", "enriched_reports", "enrichment_stats", "points_sections",
    "embed_hash", "reconcile", "cosine_topk", "classify_run", "conclusion_write", "cost_per_session",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "changeflow-bench")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
