import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from lakeloom.sources import latest_folders, list_landing_files, read_full_snapshot, read_incremental

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()),
                       T.StructField("missing", T.IntegerType())])


def put(base, y, m, d, h, name, ids):
    folder = os.path.join(base, y, m, d, h)
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "v": [f"{name}-{i}" for i in ids],
                             "extra": ids}), os.path.join(folder, name))


def test_latest_folders_numeric_order_and_fewer_than_n(spark, tmp_base):
    put(tmp_base, "2024", "1", "9", "9", "a.parquet", [1])
    put(tmp_base, "2024", "1", "10", "0", "b.parquet", [2])
    put(tmp_base, "2023", "12", "31", "23", "c.parquet", [3])
    got = latest_folders(list_landing_files(spark, tmp_base), 5)
    assert [f.rsplit("/", 4)[1:] for f, _ in got] == [
        ["2024", "1", "10", "0"], ["2024", "1", "9", "9"], ["2023", "12", "31", "23"]]


def test_incremental_reads_newest_n_with_schema(spark, tmp_base):
    put(tmp_base, "2024", "01", "30", "04", "x.parquet", [1, 2])
    put(tmp_base, "2024", "01", "30", "05", "y.PARQUET", [3])
    put(tmp_base, "2024", "01", "30", "05", "z.parquet", [4])
    with open(os.path.join(tmp_base, "2024", "01", "30", "05", "notes.txt"), "w") as f:
        f.write("not data")
    df = read_incremental(spark, tmp_base, SCHEMA, 1)
    assert df.columns == ["id", "v", "missing"]
    assert sorted(r.id for r in df.collect()) == [3, 4]
    assert all(r.missing is None for r in df.collect())
    assert read_incremental(spark, tmp_base, SCHEMA, 2).count() == 4
    assert read_incremental(spark, tmp_base, SCHEMA, None).count() == 4


def test_missing_base_and_no_parquet(spark, tmp_base):
    assert list_landing_files(spark, os.path.join(tmp_base, "nope")).count() == 0
    with pytest.raises(ValueError, match="no hour folder"):
        read_incremental(spark, os.path.join(tmp_base, "nope"), SCHEMA, 2)
    folder = os.path.join(tmp_base, "t", "2024", "01", "01", "00")
    os.makedirs(folder)
    with open(os.path.join(folder, "readme.txt"), "w") as f:
        f.write("x")
    with pytest.raises(ValueError, match="no Parquet file"):
        read_incremental(spark, os.path.join(tmp_base, "t"), SCHEMA, 1)
    with pytest.raises(ValueError, match="no Parquet file"):
        read_full_snapshot(spark, os.path.join(tmp_base, "t"), SCHEMA)


def test_full_snapshot_latest_file_or_folder(spark, tmp_base):
    put(tmp_base, "2024", "01", "01", "00", "part-1.parquet", [1])
    put(tmp_base, "2024", "01", "02", "00", "part-1.parquet", [2])
    put(tmp_base, "2024", "01", "02", "00", "part-2.parquet", [3])
    assert [r.id for r in read_full_snapshot(spark, tmp_base, SCHEMA).collect()] == [3]
    assert read_full_snapshot(spark, tmp_base, SCHEMA, "latest_folder").count() == 2


def test_corrupt_file_skipped(spark, tmp_base):
    put(tmp_base, "2024", "01", "01", "00", "good.parquet", [1, 2])
    with open(os.path.join(tmp_base, "2024", "01", "01", "00", "junk.parquet"), "wb") as f:
        f.write(b"definitely not parquet")
    assert read_incremental(spark, tmp_base, SCHEMA, 1).count() == 2
    with pytest.raises(Exception):
        read_incremental(spark, tmp_base, SCHEMA, 1, ignore_corrupt_files=False).collect()


def test_newest_delivery_wins_ties(spark, tmp_base):
    from lakeloom.plans.loads import load_raw_incremental
    from lakeloom.spec import TableSpec
    ts = dt.datetime(2024, 1, 1)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("v", T.StringType())])
    for h, v in (("9", "older"), ("10", "newer")):
        folder = os.path.join(tmp_base, "tbl", "2024", "1", "1", h)
        os.makedirs(folder)
        pq.write_table(pa.table({"id": pa.array([1], pa.int64()), "ts": pa.array([ts], pa.timestamp("us")),
                                 "v": [v]}), os.path.join(folder, "f.parquet"))
    spec = TableSpec(target="landing_ties", source="tbl", load_type="INCREMENTAL", schema=schema,
                     key=("id",), timestamp="ts", update_op=">=", landing_base=tmp_base)
    load_raw_incremental(spark, spec, n_folders=2)
    assert [r.v for r in spark.table("landing_ties").collect()] == ["newer"]


def test_walk_matches_listing_and_skips_hidden(spark, tmp_base):
    from lakeloom.sources import newest_folders, walk_newest_folders
    put(tmp_base, "2024", "1", "9", "9", "a.parquet", [1])
    put(tmp_base, "2024", "1", "10", "0", "b.parquet", [2])
    put(tmp_base, "2024", "1", "10", "0", "c.PARQUET", [3])
    put(tmp_base, "2023", "12", "31", "23", "d.parquet", [4])
    put(tmp_base, "2025", "_temporary", "1", "1", "e.parquet", [5])     # hidden: skipped
    for n in (1, 2, 3, 7):
        walked = walk_newest_folders(spark, tmp_base, n)
        listed = latest_folders(list_landing_files(spark, tmp_base), n)
        assert [f for f, _ in walked] == [f for f, _ in listed]
        assert [len(fs) for _, fs in walked] == [k for _, k in listed]
    assert walk_newest_folders(spark, os.path.join(tmp_base, "nope"), 2) == []
    # name=value folders and an empty newest hour (it counts, as a folder walk does)
    put(tmp_base + "/kv", "year=2024", "month=2", "day=1", "hour=7", "a.parquet", [1])
    put(tmp_base + "/kv", "year=2024", "month=2", "day=1", "hour=10", "b.parquet", [2])
    os.makedirs(os.path.join(tmp_base, "kv", "year=2024", "month=2", "day=1", "hour=11"))
    got = newest_folders(spark, tmp_base + "/kv", 2)
    assert [f.rsplit("/", 1)[1] for f, _ in got] == ["hour=11", "hour=10"]
    assert [len(fs) for _, fs in got] == [0, 1]
    assert [r.id for r in read_incremental(spark, tmp_base + "/kv", SCHEMA, 2).collect()] == [2]


def test_catch_up_reads_every_hour_since_the_last_load(spark, tmp_base):
    from lakeloom.plans.loads import load_raw_incremental
    from lakeloom.spec import TableSpec
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])

    def hour(h, *ids):
        folder = os.path.join(tmp_base, "it's", "2024", "1", "1", str(h))
        os.makedirs(folder, exist_ok=True)
        pq.write_table(pa.table({"id": pa.array(ids, pa.int64()),
                                 "ts": pa.array([dt.datetime(2024, 1, 1, h)] * len(ids), pa.timestamp("us"))}),
                       os.path.join(folder, f"f{ids[0]}.parquet"))

    def spec(target, **kw):
        return TableSpec(target=target, source="it's", load_type="INCREMENTAL", schema=schema, key=("id",),
                         timestamp="ts", update_op=">=", landing_base=tmp_base, n_folders=1, **kw)

    def ids(target):
        return sorted(r.id for r in spark.table(target).collect())

    hour(1, 1)
    hour(9, 2)
    for target, catch_up in (("caught_up", True), ("not_caught_up", False)):
        load_raw_incremental(spark, spec(target, catch_up=catch_up), record=False)
        assert ids(target) == [2]
    hour(9, 3)                      # late, in an hour that was loaded
    for h in (10, 11, 12):          # three runs were missed
        hour(h, h)
    load_raw_incremental(spark, spec("not_caught_up", catch_up=False), record=False)
    assert ids("not_caught_up") == [2, 12]
    assert load_raw_incremental(spark, spec("caught_up"), record=False).source_rows == 4   # the new files
    assert ids("caught_up") == [2, 3, 10, 11, 12]
    assert load_raw_incremental(spark, spec("caught_up"), record=False).source_rows == 0


def test_newest_folders_since_without_gateway(spark, tmp_base, monkeypatch):
    from lakeloom.sources import landing
    for h in ("1", "2", "9", "10"):
        put(tmp_base, "2024", "1", "1", h, "a.parquet", [1])
    want = [f for f, _ in landing.newest_folders(spark, tmp_base, 1, "2024/1/1/2")]
    assert [f.rsplit("/", 1)[1] for f in want] == ["10", "9", "2"]
    monkeypatch.setattr(landing, "walk_newest_folders", lambda *a: None)
    assert [f for f, _ in landing.newest_folders(spark, tmp_base, 1, "2024/1/1/2")] == want
