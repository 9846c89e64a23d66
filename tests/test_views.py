"""Stable views and rows in ranges of the key's hash."""

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.sinks import append_history, overwrite_table, prune_versions, read_version, restore, rows_table, upsert_table, \
    versions
from lakeloom.sinks.tables import get_note
from lakeloom.spec import TableSpec

DDL = "k long, s string, t long, v string"


def batch(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_seconds("t")).drop("t")


def rows_of(spark, name):
    return sorted((str(r.k), str(r.s), str(r.ts), str(r.v)) for r in spark.table(name).collect())


def test_ranges_give_the_same_rows_as_a_plain_table(spark):
    rng = random.Random(11)
    for step in range(4):
        keys = rng.sample(range(300), 30 if step else 200)
        rows = [(k, f"s{k % 3}" if k % 7 else None, 1000 * step + rng.randint(0, 900), f"v{step}") for k in keys]
        rows += [(None, "s", 5, "n"), (None, "s", 5, "n")]
        upsert_table(batch(spark, rows), "plain_u", ["k", "s"], "ts", ">")
        upsert_table(batch(spark, rows), "ranges_u", ["k", "s"], "ts", ">", hash_ranges=(8, None, 5, None)[step])
        assert rows_of(spark, "ranges_u") == rows_of(spark, "plain_u")
    assert spark.table("ranges_u").columns == spark.table("plain_u").columns
    assert spark.sql("SHOW PARTITIONS " + rows_table(spark, "ranges_u")).count() <= 5


def test_small_batch_rewrites_its_ranges_only(spark):
    upsert_table(batch(spark, [(k, "s", 1, "old") for k in range(2000)]), "many_u", ["k"], "ts", ">", hash_ranges=64)
    before = {f.rsplit("/", 1)[0] for f in spark.table("many_u").inputFiles()}
    assert len(before) == 64
    # the key arrives as a narrower number, which has the same range
    small = batch(spark, [(5, "s", 2, "new"), (77, "s", 2, "new"), (99_999, "s", 2, "new")], DDL.replace("long", "int", 1))
    res = upsert_table(small, "many_u", ["k"], "ts", ">")
    after = {f.rsplit("/", 1)[0] for f in spark.table("many_u").inputFiles()}
    assert res.partitions_rewritten <= 3 and len(before & after) >= 61
    assert (res.inserted, res.updated) == (1, 2)
    assert spark.table("many_u").count() == 2001 and spark.table("many_u").filter("v = 'new'").count() == 3
    plan = spark.table(rows_table(spark, "many_u")).filter("_range in (3, 4)")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [_range" in plan.toString()


def test_widened_key_keeps_its_range(spark):
    narrow = DDL.replace("long", "int", 1)
    upsert_table(batch(spark, [(k, "s", 1, "old") for k in range(50)], narrow), "wide_u", ["k"], "ts", ">", hash_ranges=4)
    upsert_table(batch(spark, [(7, "s", 2, "new"), (1 << 40, "s", 2, "new")]), "wide_u", ["k"], "ts", ">", widen=True)
    assert spark.table("wide_u").schema["k"].dataType.simpleString() == "bigint"
    assert spark.table("wide_u").count() == 51 and spark.table("wide_u").filter("v = 'new'").count() == 2


class Crash(Exception):
    pass


@pytest.mark.parametrize("ranges", [None, 4])
def test_readers_find_the_table_at_every_catalog_call(spark, monkeypatch, ranges):
    name = f"gapless_{ranges}"
    first, second = [(k, "s", 1, "old") for k in range(20)], [(k, "s", 2, "new") for k in range(5)]
    upsert_table(batch(spark, first), name, ["k"], "ts", ">", stable_view=True, hash_ranges=ranges, notes={"n": "1"})
    states, real = [], type(spark).sql

    def look():
        news = real(spark, f"SELECT count(*), count_if(v = 'new') FROM {name}").first()
        states.append((tuple(news), get_note_plain()))

    def get_note_plain():
        with monkeypatch.context() as inner:
            inner.setattr(type(spark), "sql", real)
            return get_note(spark, name, "n")

    def sql(self, text, *a, **kw):
        look()
        out = real(self, text, *a, **kw)
        look()
        return out

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", sql)
        upsert_table(batch(spark, second), name, ["k"], "ts", ">", notes={"n": "2"})
        overwrite_table(batch(spark, second), name, notes={"n": "3"}, bucket_cols=["k"])
    # rows and marks switch together, and nothing else is ever seen
    seen = [s for i, s in enumerate(states) if not i or s != states[i - 1]]
    assert seen == [((20, 0), "1"), ((20, 5), "2"), ((5, 5), "3")]


@pytest.mark.parametrize("ranges", [None, 4])
@pytest.mark.parametrize("at", range(1, 8))
def test_write_that_dies_then_runs_again(spark, monkeypatch, ranges, at):
    name = f"dies_{ranges}_{at}"
    upsert_table(batch(spark, [(k, "s", 1, "old") for k in range(20)]), name, ["k"], "ts", stable_view=True,
                 hash_ranges=ranges)
    new = batch(spark, [(k, "s", 2, "new") for k in range(15, 25)])
    seen, real = [], type(spark).sql

    def sql(self, text, *a, **kw):
        if text.startswith(("ALTER", "CREATE", "DROP")):
            seen.append(text)
            if len(seen) == at:
                raise Crash(text)
        return real(self, text, *a, **kw)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", sql)
        try:
            upsert_table(new, name, ["k"], "ts")
        except Crash:
            pass
    assert spark.table(name).count() in (20, 25)
    upsert_table(new, name, ["k"], "ts")
    got = sorted((r.k, r.v) for r in spark.table(name).collect())
    assert got == [(k, "old" if k < 15 else "new") for k in range(25)]


def test_partitioned_view_prunes_and_keeps_folders(spark):
    rows = batch(spark, [(k, f"s{k % 3}", 1, "old") for k in range(30)])
    upsert_table(rows, "parts_u", ["k"], "ts", partition_cols=["s"], stable_view=True)
    res = upsert_table(batch(spark, [(4, "s1", 2, "new")]), "parts_u", ["k"], "ts", partition_cols=["s"])
    assert res.partitions_rewritten == 1 and spark.table("parts_u").count() == 30
    assert all("s=s1" in f for f in spark.table("parts_u").filter("s = 's1'").inputFiles())
    for _ in range(3):
        upsert_table(batch(spark, [(4, "s1", 3 + _, "newer")]), "parts_u", ["k"], "ts", partition_cols=["s"])
    prune_versions(spark, "parts_u", keep=0, entries=0)
    assert spark.table("parts_u").count() == 30 and spark.table("parts_u").filter("v = 'newer'").count() == 1


def test_versions_of_a_view(spark):
    for step in (1, 2):
        res = upsert_table(batch(spark, [(k, "s", step, f"v{step}") for k in range(10 * step)]), "restored_u", ["k"], "ts",
                           hash_ranges=4, notes={"load": str(step)})
        append_history(spark, res)
    newest, oldest = versions(spark, "restored_u").collect()
    old = read_version(spark, "restored_u", oldest["version"])
    assert old.columns == spark.table("restored_u").columns and old.count() == 10
    assert prune_versions(spark, "restored_u", keep=0) == []
    restore(spark, "restored_u", oldest["version"])
    assert spark.table("restored_u").count() == 10 and get_note(spark, "restored_u", "load") == "1"
    res = upsert_table(batch(spark, [(3, "s", 9, "again")]), "restored_u", ["k"], "ts")
    assert res.partitions_rewritten == 1 and spark.table("restored_u").count() == 10
    restore(spark, "restored_u", newest["version"], marks=False)
    assert spark.table("restored_u").count() == 20 and get_note(spark, "restored_u", "load") == "1"


def test_refusals(spark):
    upsert_table(batch(spark, [(1, "s", 1, "x")]), "plain_r", ["k"], "ts")
    with pytest.raises(ValueError, match="is a table"):
        upsert_table(batch(spark, [(1, "s", 1, "x")]), "plain_r", ["k"], "ts", stable_view=True)
    with pytest.raises(ValueError, match="without partition columns"):
        upsert_table(batch(spark, [(1, "s", 1, "x")]), "none_r", ["k"], "ts", partition_cols=["s"], hash_ranges=4)
    with pytest.raises(ValueError, match="cannot have a column"):
        upsert_table(batch(spark, [(1, "s", 1, "x")]).withColumn("_range", F.lit(1)), "none_r", ["k"], "ts", hash_ranges=4)
    with pytest.raises(ValueError, match="hash_ranges"):
        TableSpec(target="t", source="s", key=("k",), partition_cols=("d",), hash_ranges=4)
    empty = batch(spark, []).filter("false")
    upsert_table(empty, "empty_u", ["k"], "ts", hash_ranges=4)
    assert spark.table("empty_u").count() == 0
    upsert_table(batch(spark, [(1, "s", 1, "x")]), "empty_u", ["k"], "ts")
    assert rows_of(spark, "empty_u") == rows_of(spark, "plain_r")
