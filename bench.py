"""Seconds per query: one JSON line.

BENCH_SF_DIR (default sf0.1) names the tables, BENCH_CPUS the cores.  All queries run once to
warm up and then BENCH_RUNS times; the median counts.  Results go to Spark's ``noop`` sink,
which computes every row and keeps none.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from recspark.plans.suite import QUERIES  # noqa: E402

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("recspark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {name: [] for name in QUERIES}
    for _ in range(1 + runs):
        for name in QUERIES:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - start)
    seconds = {name: round(statistics.median(ts[1:]), 3) for name, ts in times.items()}
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
