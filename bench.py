"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the cores. Each query is run twice to a
sink that discards its rows; the faster run counts, which leaves JIT warm-up out.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from corpusloom.plans import catalog  # noqa: E402

HEADLINE = [
    "clean_valid", "clean_rejects", "scd_classify", "scd_documents", "scd_chunks",
    "idempotent_rerun", "chunk_windows", "docs_without_chunks", "feature_hash_embed",
    "asof_checksum", "audit_runs", "reconciliation", "knn_exact", "ivf_search",
    "ivf_train_assign", "ivf_full_probe", "index_roundtrip", "retrieve_exact",
    "retrieval_metrics", "ingest_jsonl_roundtrip", "three_run_scenario",
]
ONCE = {"three_run_scenario"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds = {}
    # Several queries share this warehouse; its build is timed apart from them.
    start = time.perf_counter()
    catalog.build_shared(spark, folder)
    seconds["shared_warehouse"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        best = float("inf")
        for _ in range(1 if name in ONCE else 2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
