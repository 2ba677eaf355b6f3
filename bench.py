"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs in full into a
sink that keeps nothing, once to warm up and once timed.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.catalogue import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "scan_index", "parse_index", "parse_index_fixed", "filter_annual", "monthly_counts",
    "select_filings", "parse_date", "fetch_target", "describe_text", "profile_columns",
    "distinct_counts", "batch_counts", "row_index", "assign_part", "assign_part_by_file",
    "plan_periods", "pending_filings", "resolve_attempts", "pick_document_a", "pick_document_b",
    "resolve_documents", "outcome_records", "clean_pages", "fetch_run", "scan_csv_text",
    "write_parts", "write_documents", "compact_parts", "stream_filter", "stream_clean",
)


def session():
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("docketflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if not os.environ.get("BENCH_WORK_DIR"):
        os.environ["BENCH_WORK_DIR"] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = builder.config("spark.checkpoint.dir", os.environ["BENCH_WORK_DIR"]).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark, name):
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    spark = session()
    names = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    times = {}
    for name in names:
        run(spark, name)
        times[name] = round(run(spark, name), 3)
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
