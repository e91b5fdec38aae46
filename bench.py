"""Times every registered query and prints one JSON line.

The tables of the warehouse are built first and timed one by one ("build:..."); the
queries then read them. Each query runs three times, the first time as a warm-up, and the
median counts. "value" adds up both.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwise.registry import queries  # noqa: E402
from tillwise.session import local_session  # noqa: E402
from tillwise.warehouse import Warehouse  # noqa: E402

BUILDS = ("clean", "star", "customer_orders", "rfm", "segments", "query_history")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:]
    spark = local_session(cores)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    seconds = {}
    warehouse = Warehouse(spark, folder)
    for name in BUILDS:
        seconds[f"build:{name}"] = timed(getattr(warehouse, name))
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue

        def run():
            query(spark, folder).write.format("noop").mode("overwrite").save()

        seconds[name] = statistics.median(timed(run) for _ in range(runs))
        if chosen:
            print(f"{name} {seconds[name]:.3f}", file=sys.stderr)

    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.driver.memory")
    report = {
        "metric": "all_queries_warm_median",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "runs": runs,
        "config": {"master": spark.sparkContext.master, **{key: spark.conf.get(key) for key in keys}},
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
