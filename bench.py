"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsegrid.plans.catalog import QUERIES  # noqa: E402
from pulsegrid.session import local_session  # noqa: E402

REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
HEADLINE = [
    "parse_readings_record",
    "metrics_1min",
    "metrics_10min",
    "all_alerts",
    "anchored_hr",
    "insert_if_absent",
    "topic_stats",
    "table_stats",
    "table_page",
    "quality_report",
    "gps_heading",
    "gps_grid",
    "order_items",
    "order_state",
    "sql_join",
    "sql_rank",
]


def run(spark, name, sf_dir, repeat=1):
    """Median wall time of ``repeat`` full executions (planning included)."""
    times = []
    for _ in range(repeat):
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.time() - t0)
    return sorted(times)[len(times) // 2]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="pulsegrid-bench")
    spark.conf.set("pulsegrid.scan.partitions", cpus if cpus.isdigit() else "8")  # the tables are single row groups
    # warm-up: JIT and Python workers
    run(spark, "hr_window_metrics", sf_dir)
    times = {}
    for n in names:
        times[n] = round(run(spark, n, sf_dir, REPEAT), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
