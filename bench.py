"""Time every registered query; prints one JSON line.

BENCH_SF_DIR  folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local master (default: all)
BENCH_RUNS    runs per table query, the fastest counts (default 3); streams and the job run once
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.plans import QUERIES  # noqa: E402


STREAMS = ("stream_", "stored_", "job_", "late_", "rollup_", "compacted_", "handover_")


def session(cpus: int) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="run-")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )


def seconds(query, spark: SparkSession, folder: str) -> float:
    """One run: building the query, streaming included, and computing all its rows."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def scale(folder: str) -> float | str:
    """The number in a folder name like ``sf0.1``, else the name."""
    name = os.path.basename(folder.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1)))
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("alerts_5m", "stream_alerts"):
        seconds(QUERIES[name], spark, folder)
    times = {}
    for name, query in QUERIES.items():
        repeats = 1 if name.startswith(STREAMS) else runs
        times[name] = round(min(seconds(query, spark, folder) for _ in range(repeats)), 3)
    spark.stop()
    result = {
        "metric": "total time of all registered queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": scale(folder),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
