"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads, BENCH_RUNS the timed runs
per query after one warm-up; the median counts. Each run builds the plan anew and computes every
column of every row.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from heatwright.session import local_session  # noqa: E402
from heatwright.workloads.queries import QUERIES  # noqa: E402

HEADLINE = [
    "event_milestones",
    "latest_measurement_oxygen",
    "chemistry_rows",
    "latest_element",
    "element_pivot",
    "additions_by_heat_reference",
    "additions_by_heat_corrected",
    "addition_pivot",
    "additions_detail_list",
    "heat_sheet_reference",
    "ref_report_newest",
    "ref_report_since",
    "last_heats_list",
    "lookup_defaults",
    "upsert_merge",
    "replace_table",
    "heat_report_wide",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    result = {
        "metric": "total time of the headline report queries (median per query)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
