"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``prepare`` is the time to derive and store the provider exports (and to warm the JVM up); the queries
then read them as a run would. Each figure is the median of three runs, plan building included.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from ledgerloom.plans.derived import Derived
from ledgerloom.plans.queries import QUERIES

HEADLINE = (
    "rate_versions", "lifecycle_fold", "fee_row_fold", "dedup_with_surplus", "dual_date_resolution", "conform_union",
    "fx_restatement", "asof_pricing", "contracted_fee", "two_sided_match", "gross_cause", "cause_rollup",
    "recon_summary", "recon_waterfall", "profile_lifecycle_sets")
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "128m")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    Derived(spark, sf_dir).prepare()
    timings = {"prepare": round(time.perf_counter() - start, 3)}
    for name in HEADLINE:
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds), 3)
    total = round(sum(v for k, v in timings.items() if k != "prepare"), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
