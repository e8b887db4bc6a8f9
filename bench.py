"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablestream.plans import QUERIES  # noqa: E402


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablestream-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites for error messages cost a round trip to the JVM per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's code paths once, outside the timings.
    spark.read.parquet(f"{data}/region.parquet").groupBy("r_name").count().collect()
    seconds, failed = {}, {}
    for name in names:
        began = time.perf_counter()
        try:
            QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
        except Exception as error:
            failed[name] = str(error)[:200]
    report = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"),
    }
    if failed:
        report["failed"] = failed
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
