"""Time the whole run and the headline queries; prints one JSON line.

BENCH_SF_DIR names the input folder (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
`whole_run` is one cold build of the warehouse in a fresh session (survey, classification, month
replacement, rollups, marts, summary). The other numbers are the median of three runs after it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tripmart.catalog.queries import QUERIES
from tripmart.catalog.store import driver_warehouse
from tripmart.session import local_session

HEADLINE = (
    "classified_trips",
    "status_counts",
    "fct_trips",
    "mart_daily_trip_metrics",
    "mart_route_metrics",
    "overview",
    "overview_zone",
    "daily_metrics_page",
    "hourly_demand_page",
    "revenue_page",
    "zones",
    "zone_summary",
    "top_routes",
    "anomalies",
    "dq_unique",
    "dq_relationships",
)
RUNS = 3


def consume(frame) -> None:
    """Compute every row and column without moving them to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, int(cpus), **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    started = time.perf_counter()
    driver_warehouse(spark, sf_dir)
    seconds["whole_run"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            consume(QUERIES[name](spark, sf_dir))
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds: whole run plus headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
