"""Time the headline queries: one warm-up, then the median of three runs into a no-op sink.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores; names on the command line
replace the headline list. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from telemetry_lake.catalog import QUERIES
from telemetry_lake.session import get_session

HEADLINE = [
    # scans, shaping, scalar functions
    "scan_json_permissive", "melt", "metric_code_lookup", "word_count", "si_prefix", "round_half_down",
    # joins
    "join_decode", "join_anti", "latest_per_key_ties", "asof_backward", "asof_forward", "point_in_polygon",
    "tt_join_outer", "st_join_left", "ss_join_outer", "sg_join_left",
    # aggregates and windows
    "rollup_year", "rollup_month", "rollup_day", "rollup_breakdown_year", "rollup_breakdown_month", "lag_delta",
    "partition_aggs", "pivot_count",
    # jobs
    "status_priority", "ticket_stats", "resolution_by_account", "tickets_by_account", "wip_tickets",
    "status_durations", "device_latest", "metric_history_load", "usage_by_remote", "signal_vs_coverage",
    "compact_metrics", "incremental_process",
    # streams
    "stream_word_count", "stream_ss_join_inner", "stream_st_join_left", "stream_tt_join_outer",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
            # Local cores only: AQE would otherwise size small shuffles down to one task.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline query time, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
