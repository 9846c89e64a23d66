"""Time the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced to completion with the ``noop`` sink (the whole plan
runs, nothing is collected to the driver). Flows that load tables include
their writes. The JVM and the Python workers are warmed once before timing.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeloom.session import build_session  # noqa: E402
from lakeloom.workloads import QUERIES  # noqa: E402

HEADLINE = [
    "revenue_latest_facts",      # flagship: columns -> YMD -> latest per key -> enrichment
    "price_revenue",
    "dedup_latest",
    "dedup_dirty_keys",
    "latest_price",
    "dedup_date_timestamp",
    "transform_chain",
    "incremental_filter",
    "incremental_filter_pruned",
    "date_watermark_filter",
    "upsert_gt",
    "upsert_metrics",
    "upsert_fixed_partition",
    "create_on_missing",
    "full_overwrite_partitioned",
    "clean_full_e2e",
    "clean_incremental_e2e",
    "raw_full_e2e",
    "raw_incremental_e2e",
    "landing_latest_folders",
    "landing_schema_drift",
    "stream_upsert",
    "run_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="lakeloom-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "6g")})
    spark.sparkContext.setLogLevel("ERROR")
    # warm the JVM (class loading, codegen caches) on the smallest input, and
    # start the Python workers once (the footer check is the one Python step)
    QUERIES["dedup_latest"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(8).mapInPandas(lambda it: it, "id long").write.format("noop") \
        .mode("overwrite").save()
    only = [q for q in sys.argv[1:] if q in QUERIES] or HEADLINE
    times: dict[str, float] = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
