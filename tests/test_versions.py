"""Tables as of a load: read, restore, and pruning that keeps readable entries."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from lakeloom.plans.loads import load_clean_incremental
from lakeloom.sinks.history import table_history
from lakeloom.sinks.tables import get_note, overwrite_table, prune_versions
from lakeloom.sinks.versions import read_version, restore, versions
from lakeloom.spec import TableSpec

DDL = "k long, ts timestamp, v string, p int"


def batch(spark, rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, day), v, p) for k, day, v, p in rows], DDL)


def loads(spark, parts, buckets=None):
    """Three loads; the last one is bad. Returns the spec and the rows after each."""
    tag = uuid.uuid4().hex[:8]
    spec = TableSpec(target=f"versioned_{tag}", source=f"versioned_src_{tag}", load_type="INCREMENTAL", key=("k",),
                     timestamp="ts", partition_cols=parts, buckets=buckets)
    after = []
    for rows in ([(k, 1, "a", k % 3) for k in range(12)], [(0, 2, "b", 0), (20, 2, "b", 7)],
                 [(k, 3, "bad", 5) for k in range(6)]):
        overwrite_table(batch(spark, rows), spec.source)
        load_clean_incremental(spark, spec)
        after.append(rows_of(spark.table(spec.target)))
    return spec, after


def rows_of(df):
    return sorted((r.k, r.v, r.p) for r in df.select("k", "v", "p").collect())


@pytest.mark.parametrize("parts,buckets", [(None, None), (("p",), None), (None, 3)])
def test_read_and_restore(spark, parts, buckets):
    spec, after = loads(spark, parts, buckets)
    entries = [r["version"] for r in versions(spark, spec.target).collect()][::-1]
    assert len(entries) == 3
    for v, want in zip(entries, after):
        assert rows_of(read_version(spark, spec.target, v)) == want
    first = versions(spark, spec.target).filter(F.col("version") == entries[0]).first()["ts"]
    assert rows_of(read_version(spark, spec.target, at=first)) == after[0]
    res = restore(spark, spec.target, entries[1])
    assert res.operation == "RESTORE" and rows_of(spark.table(spec.target)) == after[1]
    assert table_history(spark, spec.target).first()["operation"] == "RESTORE"
    # the next load merges into the restored rows
    overwrite_table(batch(spark, [(1, 4, "c", 1)]), spec.source)
    load_clean_incremental(spark, spec)
    assert rows_of(spark.table(spec.target)) == sorted([(1, "c", 1)] + [r for r in after[1] if r[0] != 1])
    # and the bad state can be had back
    restore(spark, spec.target, entries[2])
    assert rows_of(spark.table(spec.target)) == after[2]


def test_partitions_are_pruned_in_an_old_version(spark):
    spec, _ = loads(spark, ("p",))
    v = versions(spark, spec.target).collect()[-1]["version"]
    files = read_version(spark, spec.target, v).filter("p = 2").inputFiles()
    assert files and all("/p=2/" in f for f in files)


def test_pruning_keeps_the_entries_asked_for(spark):
    spec, after = loads(spark, ("p",))
    entries = [r["version"] for r in versions(spark, spec.target).collect()][::-1]
    read_version(spark, spec.target, entries[0])
    assert prune_versions(spark, spec.target, keep=0) == []
    assert rows_of(read_version(spark, spec.target, entries[0])) == after[0]
    # partition 0 of the second load is in no live location once the third moved its keys
    gone = prune_versions(spark, spec.target, keep=0, entries=1)
    assert rows_of(spark.table(spec.target)) == after[2]
    left = [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{spec.target}*'").collect()]
    assert left == [spec.target]
    if gone:
        with pytest.raises(ValueError, match="pruned"):
            for v in entries[:2]:
                read_version(spark, spec.target, v)


def test_marks_go_back_and_a_dropped_table_comes_back(spark):
    from lakeloom.sinks.history import append_history
    from lakeloom.sinks.tables import set_note, upsert_table
    name = f"marked_{uuid.uuid4().hex[:8]}"
    for step in (1, 2):
        res = upsert_table(batch(spark, [(step, step, "x", 1)]), name, ["k"], "ts", partition_cols=["p"],
                           notes={"load": str(step)})
        if step == 2:
            set_note(spark, name, "later", "it's")
        append_history(spark, res)
    old, = [r["version"] for r in versions(spark, name).collect()][1:]
    restore(spark, name, old, marks=False, record=False)
    assert get_note(spark, name, "load") == "2" and rows_of(spark.table(name)) == [(1, "x", 1)]
    restore(spark, name, old)
    assert get_note(spark, name, "load") == "1" and get_note(spark, name, "later") is None
    spark.sql(f"DROP TABLE {name}")
    restore(spark, name, at=dt.datetime.now())
    assert get_note(spark, name, "load") == "1" and rows_of(spark.table(name)) == [(1, "x", 1)]
    with pytest.raises(ValueError, match="no recorded load"):
        read_version(spark, name, "0_0")
    with pytest.raises(ValueError, match="not both"):
        read_version(spark, name)
