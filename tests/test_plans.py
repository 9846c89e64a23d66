"""Physical-plan checks of the flagship query: what reaches the scans and
where the shuffles are."""

import re

from lakeloom.workloads import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_pushes_and_limits_before_shuffle(spark):
    plan = plan_of(QUERIES["revenue_latest_facts"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    events = [s for s in schemas if "event_type" in s]
    assert events and "props" not in events[0]                 # column pruning
    orders = [s for s in schemas if "o_custkey" in s]
    assert orders and "o_orderstatus" not in orders[0]
    # both dedups keep one row per key per task before their exchange
    assert plan.count("WindowGroupLimit") >= 4 and plan.count("Partial") >= 2
    assert "LeftOuter" in plan


def test_incremental_filter_is_a_literal_at_the_scan(spark):
    plan = plan_of(QUERIES["incremental_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_upsert_spreads_null_keys_with_a_salt(spark):
    plan = plan_of(QUERIES["upsert_gt"](spark, SF))
    assert "FullOuter" in plan and "xxhash64" in plan and "Union" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_date_watermark_prunes_partitions(spark):
    plan = plan_of(QUERIES["date_watermark_filter"](spark, SF))
    assert "PartitionFilters: [isnotnull(date" in plan and "(date#" in plan
