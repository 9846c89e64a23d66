"""The key locator: same rows, and only partitions that can hold a key are looked at."""

import random

from pyspark.sql import functions as F

from lakeloom.sinks import tables
from lakeloom.sinks.keys import holding_partitions, partition_key
from lakeloom.sinks.tables import _locations, prune_versions, upsert_table

DDL = "k long, s string, ts timestamp, v string, p int"


def batch(spark, rows):
    return spark.createDataFrame(rows, "k long, s string, t long, v string, p int") \
        .select("k", "s", F.timestamp_seconds("t").alias("ts"), "v", "p")


def rows_of(spark, name):
    return sorted((str(r.k), r.s, str(r.ts), r.v, r.p) for r in spark.table(name).collect())


def test_same_rows_as_without_the_index(spark):
    rng = random.Random(4)
    for step in range(5):
        keys = rng.sample(range(300), 60 if step else 200)
        rows = [(k, f"s{k % 3}", 1000 * step + rng.randint(0, 900), f"v{step}", (k + (step == 3)) % 6) for k in keys]
        rows += [(None, "s", 5, "n", 2)]
        for name, on in (("indexed_t", True), ("plain_t", False)):
            upsert_table(batch(spark, rows), name, ["k", "s"], "ts", ">", partition_cols=["p"], key_index=on)
        assert rows_of(spark, "indexed_t") == rows_of(spark, "plain_t")


def test_only_partitions_that_can_hold_a_key_are_scanned(spark, monkeypatch):
    rows = [(1000 * p + i, "s", 10, "old", p) for p in range(12) for i in range(50)]
    upsert_table(batch(spark, rows), "located_t", ["k"], "ts", ">", partition_cols=["p"], key_index=True)
    new = batch(spark, [(2003, "s", 20, "new", 2), (7049, "s", 20, "moved", 9)])
    live = {"\u0001".join(v): loc for v, loc in _locations(spark, "located_t").items()}
    assert sorted(holding_partitions(new, ["k"], live)) == ["2", "7"]
    assert holding_partitions(batch(spark, [(99_999, "s", 1, "x", 0)]), ["k"], live) == []
    plan = spark.table("located_t").filter(partition_key(["p"]).isin(["2", "7"])).select("k", "p")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "concat_ws" in text.split("PartitionFilters")[1]
    files = plan.inputFiles()
    assert {f.split("p=")[1].split("/")[0] for f in files} == {"2", "7"}
    seen = []
    real = tables.holding_partitions
    monkeypatch.setattr(tables, "holding_partitions", lambda *a: seen.append(real(*a)) or seen[-1])
    res = upsert_table(new, "located_t", ["k"], "ts", ">", partition_cols=["p"], key_index=True)
    assert sorted(seen[0]) == ["2", "7"] and res.partitions_rewritten == 3
    got = {r.k: (r.v, r.p) for r in spark.table("located_t").filter("v <> 'old'").collect()}
    assert got == {2003: ("new", 2), 7049: ("moved", 9)} and spark.table("located_t").count() == 600
    # the index follows the moved key, and old versions take theirs along
    live = {"\u0001".join(v): loc for v, loc in _locations(spark, "located_t").items()}
    assert holding_partitions(batch(spark, [(7049, "s", 30, "y", 1)]), ["k"], live) == ["9"]
    upsert_table(batch(spark, [(k, "s", 40, "all", p) for k, _, _, _, p in rows]), "located_t", ["k"], "ts", ">",
                 partition_cols=["p"], key_index=True)
    assert prune_versions(spark, "located_t", keep=0) and spark.table("located_t").count() == 600


def test_table_without_an_index_is_scanned_whole(spark):
    rows = [(i, "s", 10, "old", i % 3) for i in range(30)]
    upsert_table(batch(spark, rows), "late_index_t", ["k"], "ts", ">", partition_cols=["p"])
    live = {"\u0001".join(v): loc for v, loc in _locations(spark, "late_index_t").items()}
    new = batch(spark, [(5, "s", 20, "new", 2)])
    assert holding_partitions(new, ["k"], live) is None
    upsert_table(new, "late_index_t", ["k"], "ts", ">", partition_cols=["p"], key_index=True)
    assert spark.table("late_index_t").filter("v = 'new'").count() == 1 and spark.table("late_index_t").count() == 30
