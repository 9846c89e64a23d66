"""Print the formatted physical plan of registered queries.

    python tools/show_plans.py [sf_dir] [key ...]

Shows what reaches each scan (ReadSchema, PushedFilters, PartitionFilters),
where the exchanges are, whether a WindowGroupLimit runs before them and
which join strategy was chosen. Queries that load tables run their loads
first (the plan shown is that of the returned DataFrame).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["revenue_latest_facts", "dedup_latest", "incremental_filter_pruned",
           "date_watermark_filter", "upsert_gt"]


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    from lakeloom.session import build_session
    from lakeloom.workloads import QUERIES
    spark = build_session("local[8]", 8, app_name="lakeloom-plans")
    spark.sparkContext.setLogLevel("ERROR")
    for key in args or DEFAULT:
        if key not in QUERIES:
            print(f"unknown query {key}; known: {', '.join(sorted(QUERIES))}")
            continue
        print(f"===== {key} =====")
        QUERIES[key](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
