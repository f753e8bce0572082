"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed fully with the ``noop`` sink (no driver collect) after
one warm-up of the session. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q05_describe_numeric",
    "p01_iqr_outliers_by_plan",
    "a01_group_stats_by_plan",
    "p08_correlation_matrix",
    "p07_kruskal_by_plan",
    "q03_duplicates_documents",
    "x04_tfidf_norms",
    "x06_near_duplicates",
    "x07_remove_near_duplicates",
    "c05_ari_plan_vs_region",
    "e02_metrics_by_model_horizon",
    "w02_rolling_features",
    "o01_monitor_weekly",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tessera-bench")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from tessera.plans import REGISTRY
    names = [n for n in HEADLINE if n in REGISTRY]
    if len(sys.argv) > 1:
        names = [n for n in REGISTRY if any(a in n for a in sys.argv[1:])]
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up
    times = {}
    for name in names:
        t0 = time.time()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
