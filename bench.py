"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query runs to completion into a sink that discards rows. One warm-up query starts the
JVM; every query is then timed BENCH_RUNS times (default 3), plan building included, and the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgersieve.catalog.queries import QUERIES  # noqa: E402

HEADLINE = (
    "stg_po_headers", "stg_po_items", "column_profile", "pattern_checks", "numeric_spread", "currency_distribution",
    "quarantine_po_headers", "quarantine_po_items", "silver_po_headers", "silver_po_items",
    "check_unique", "check_relationships", "check_custom", "issue_recall", "row_accounting",
    "check_report", "rule_precision", "run_metrics", "synthetic_items", "load_audit", "table_profile",
    "monitoring_latest", "stored_failures", "answer_key", "order_totals", "line_value_spread", "repeated_line_keys", "shipped_before_ordered",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgersieve-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["priority_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
