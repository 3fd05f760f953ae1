"""Wall seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from seqloom.plans.queries import QUERIES

HEADLINE = ["m1_m6_merge", "m7_merge_stats", "t3_profile", "f1_f11_features", "k1_c1_c2_c4_chunks", "k2_manifest_entries", "a3_seed_join", "s1_s2_s3_s9_fasta_round_trip", "r7_duration_quantiles", "r8_throughput"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("seqloom-bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-bench-", dir="/tmp")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = {name: QUERIES[name] for name in HEADLINE}
    cold, warm = {}, {}
    for times in (cold, warm):
        for name, f in found.items():
            began = time.perf_counter()
            f(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_total_warm", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
