"""Times the headline queries; prints one JSON line.

Each query is planned and run once unmeasured at the same scale (code generation, file listing), then timed with a
write to Spark's `noop` sink, so that every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewell.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "p0_sales_summary", "p2_filter_both_ways", "p3_formulas_in_sequence", "p4_sort_top", "p5_record_id", "p6_first_of_each_key", "p7_one_in_ten", "p8_cleanse", "p14_transpose", "p15_cross_tab", "j1_inner", "j3_right_only",
    "u1_union_by_name", "w1_other_rows", "w2_running_total_with_null", "w3_capped_balance", "a1_summarize", "a6_first_and_last", "f2_numbers", "f3_dates", "s9_update_insert", "c1_compare_clusters", "c10_keyed_mismatches", "c11_keyless_difference", "c25_reconcile",
]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.codegen.hugeMethodLimit", "8000").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
