"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. Each query runs once to warm up, then the median of three runs counts; results are written to Spark's noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from pyspark.sql import SparkSession  # noqa: E402

from chronogrid.plans import registry  # noqa: E402

HEADLINE = ("gap_clusters", "anchored_groups", "segment_change_or_gap", "rasterise_last_wins", "grid_interpolate", "interp_clamped", "tail_classify", "tail_flatten", "overhang_trim", "band_join_rewards", "interval_overlap", "robust_prior", "hist_intersection_shift", "tempo_sections", "hash_permutation", "tile_windows", "monotonic_align", "greedy_assign")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = registry.queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            begun = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begun)
        took[name] = round(statistics.median(runs[1:]), 4)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 4), "unit": "sec", "queries": took, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
