"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then RUNS times; its figure is the median. Results are computed whole and
thrown away, so the time is that of the engine and not of a client.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillvec.plans.registry import QUERIES  # noqa: E402

HEADLINE = (
    "topk_all_namespaces", "topk_one_namespace", "topk_default_namespace", "latency_summary", "latency_by_namespace",
    "throughput_ticks", "write_throughput", "layout_totals", "layout_first_files", "upsert_result", "import_accepted",
    "status_changes", "job_outcomes", "record_check", "collection_stats", "synthetic_vectors", "write_batches",
    "topk_routed", "record_changes", "backup_rows",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "cpus": int(cpus), "runs": RUNS}))


if __name__ == "__main__":
    main()
