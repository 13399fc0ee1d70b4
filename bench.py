"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS:   local cores (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cairnlake.plans import registered
from cairnlake.session import build_session

HEADLINE = [
    "bronze_flatten",
    "silver_events",
    "silver_events_global_dedup",
    "duplicate_audit",
    "quarantine_records",
    "gold_repo_daily",
    "gold_actor_daily",
    "top_repos",
    "checks_bronze",
    "checks_silver",
    "checks_gold",
    "version_type_diff",
    "version_new_rows",
    "activity_half_life",
    "hourly_traffic",
]
RUNS = 3


def timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered.queries()
    timed(queries["event_type_counts"], spark, folder)  # starts the JVM's work
    seconds = {}
    for name in HEADLINE:
        timed(queries[name], spark, folder)
        seconds[name] = round(
            statistics.median(timed(queries[name], spark, folder) for _ in range(RUNS)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
