"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the tables, cores and
repetitions. With ``--plain`` straightforward forms of the same work (one
action per number, statistics through the driver) are timed as well.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgersift.session import build_session  # noqa: E402
from ledgersift.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_pipeline_a",
    "clean_pipeline_b",
    "clean_report",
    "prof_all_checks",
    "fraud_by_day",
    "tx_by_hour",
    "feat_historical",
    "feat_historical_multi",
    "feat_materialize",
    "feat_group_max",
]


def measure(run, times: int) -> float:
    for _ in range(2):  # warm-up
        run()
    seconds = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def count_jobs(spark, name: str, run) -> int:
    """How many Spark jobs one run starts."""
    spark.sparkContext.setJobGroup(name, name)
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    times = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            # Leaves out the call site of every column, which costs more
            # than these small tables do.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def rows(name):
        return lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    queries = {name: measure(rows(name), times) for name in HEADLINE}
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "jobs": {name: count_jobs(spark, name, rows(name)) for name in HEADLINE},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if "--plain" in sys.argv:
        from bench_plain import PLAIN

        result["plain"] = {n: measure(lambda: fn(spark, folder), times) for n, fn in PLAIN.items()}
        result["plain_jobs"] = {
            n: count_jobs(spark, f"plain_{n}", lambda: fn(spark, folder)) for n, fn in PLAIN.items()
        }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
