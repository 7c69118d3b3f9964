"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from plumbline.session import SETTINGS
from registry import QUERIES

HEADLINE = [
    "k01_audit_quality", "k03_scan_members", "k03_scan_archives", "k04_freeze_decide_replay", "k05_final_gate", "k07_missing_data_audit",
    "k09_session_study", "k10_compression_study", "c08_asof_join", "c15_forward_outcome", "d13_set_fingerprint",
    "d19_ohlcv", "e04_latency_disorder", "f01_latest_n", "g02_replay_equal", "g04_replicate", "h03_redact",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
                       "spark.ui.enabled": "false", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM's work before timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
