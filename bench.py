"""Times of the headline queries: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS set the data and cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from checks.queries import all_queries
from doclake.session import configured

HEADLINE = [
    "flt1_flatten_elements",
    "flt2_flatten_pages",
    "qry1_documents_overview",
    "qry1_list_documents",
    "qry2_document_headers",
    "qry4_corpus_stats",
    "jon1_not_yet_parsed_registry_hash",
    "jon2_not_yet_parsed_parsed_hash",
    "src9_staging_paths",
    "win2_round_robin_batches",
    "win4_top_types",
    "snk5_registry_upsert",
    "udf1_parse_documents_text",
    "udf1_parse_documents_python",
    "udf3_layout_from_html",
    "agg8_type_distribution",
    "prj14_normalized_boxes",
    "run4_fold_log",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = configured(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("doclake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in HEADLINE:
        taken = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
