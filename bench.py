"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (tables) and ``BENCH_CPUS`` (local cores) come from the driver.
Every query over bars is run to the end (all rows, all columns) into Spark's no-op sink, once
to warm up and once timed. What a query lands or writes on the way goes to a checkpoint folder
of the bench, which is emptied after each.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.plans.tables import build_queries  # noqa: E402
from tickloom.sources.shared import discard  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 1


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tickloom-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    found = time.perf_counter() - start
    discard(spark)
    return found


def main() -> None:
    spark = session()
    queries = build_queries()
    times = {}
    for name in queries:
        seconds(spark, queries[name])
        times[name] = round(min(seconds(spark, queries[name]) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
