"""Time the headline queries and print one JSON line.

Each query is built and run to the end (every output row and column) once to warm up, then three
times; the median counts. Building the DataFrame is part of the time.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyledger.session import build_session  # noqa: E402
from skyledger.workload import catalog  # noqa: E402

HEADLINES = [
    "raw_envelope", "reason_counts", "quarantine", "curated",
    "silver_telemetry", "silver_comms",
    "gold_satellite_health", "gold_communication_health", "gold_contact_gaps",
    "gold_data_completeness", "gold_data_quality", "gold_pipeline_quality",
    "mission_operations_dashboard", "weakest_communication_satellite", "satellite_telemetry_volume",
    "dataset_profile",
]
ONCE = ["stream_curated", "stored_tables"]


def seconds(spark, name, sf_dir):
    start = time.perf_counter()
    catalog.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(3)), 3)
    for name in ONCE:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
