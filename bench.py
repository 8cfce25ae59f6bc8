"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): one warm-up run, then ``$BENCH_RUNS``
timed runs (default 3); reports the median per query. Each run executes the
whole plan through the ``noop`` sink (no collect to the driver) with a row
counter attached by ``observe``.

``etl_run`` is the production path: listing bronze is landed as JSON once
(untimed), then a full run writes dt-partitioned silver and publishes gold. It,
the stream and the incremental upsert write thousands of small daily
partitions on the driver data, so they run once, without a warm-up.

Prints ONE JSON line:
{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "report_topk_price",
    "listings_gold",
    "listings_silver",
    "latest_per_key",
    "upsert",
    "insert_ignore",
    "update_status",
    "topk_mean_unit",
    "box_stats",
    "box_stats_listings",
    "histogram_20",
    "filtered_kpis",
    "extract_links",
    "extract_document",
    "quarantine_few_links",
    "gold_upsert_incremental",
    "stream_ingest",
]
ONCE = {"gold_upsert_incremental", "stream_ingest"}


def main() -> None:
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from homestead.plans.catalog import QUERIES
    from homestead.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]

    spark = build_session(f"local[{cpus}]", app="homestead-bench",
                          shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g",
                                 # keep the driver's status store small over ~60 query runs
                                 "spark.sql.ui.retainedExecutions": "20",
                                 "spark.ui.retainedJobs": "50",
                                 "spark.ui.retainedStages": "50",
                                 # thousands of tiny daily partitions: list them in few tasks
                                 "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(cpus)})

    def settle() -> None:
        """Between queries: drop cached data and let the driver JVM collect,
        so one query's leftovers do not slow the next."""
        spark.catalog.clearCache()
        spark.sparkContext._jvm.System.gc()

    def run_once(name: str) -> tuple[float, int]:
        obs = Observation(f"rows_{name}_{time.monotonic_ns()}")
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir).observe(obs, F.count(F.lit(1)).alias("n"))
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0, int(obs.get["n"])

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        settle()
        took, rows[name] = run_once(name)       # warm-up
        samples = [took] if name in ONCE else [run_once(name)[0] for _ in range(runs)]
        timings[name] = round(statistics.median(samples), 4)

    if not sys.argv[1:]:
        # production path: bronze JSON already landed -> silver -> gold (versioned upsert)
        from homestead.plans.etl import run_etl
        from homestead.plans.listings import listing_bronze
        from homestead.session import scratch_path
        from homestead.sources.bronze import land_bronze
        bronze_root = scratch_path(spark, "bench-bronze")
        land_bronze(listing_bronze(spark, sf_dir), bronze_root, granularity="month")
        out_root = scratch_path(spark, "bench-etl")
        t0 = time.perf_counter()
        counts = run_etl(spark, bronze_root, f"{out_root}/silver", f"{out_root}/gold", loaded_at="2026-01-01 02:00:00")
        timings["etl_run"] = round(time.perf_counter() - t0, 4)
        rows["etl_run"] = counts.gold_rows

    out = {
        "metric": "total_median_sec",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cores": cpus,
        "spark": spark.version,
    }
    print(json.dumps(out))
    from homestead.session import remove_scratch
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
