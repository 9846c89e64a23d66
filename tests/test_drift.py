import datetime as dt
import decimal
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from lakeloom.sources.drift import DRIFT, OK, UNREADABLE, check_file, compatible
from lakeloom.sources.landing import read_full_snapshot, read_incremental

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def put(base, h, name, ids, id_type=pa.int64()):
    folder = os.path.join(base, "2024", "1", "1", h)
    os.makedirs(folder, exist_ok=True)
    ids_arr = pa.array([str(i) for i in ids]) if pa.types.is_string(id_type) else pa.array(ids, id_type)
    pq.write_table(pa.table({"id": ids_arr, "v": [f"{name}-{i}" for i in ids]}),
                   os.path.join(folder, name))


@pytest.mark.parametrize("arrow_type,target,ok", [
    (pa.int32(), T.LongType(), True),
    (pa.int64(), T.DecimalType(20, 0), True),
    (pa.uint64(), T.DecimalType(20, 0), True),
    (pa.int64(), T.IntegerType(), False),
    (pa.int32(), T.ByteType(), False),          # Spark reads it, but may wrap around
    (pa.string(), T.LongType(), False),
    (pa.float32(), T.DoubleType(), True),
    (pa.float64(), T.FloatType(), False),
    (pa.decimal128(10, 2), T.DecimalType(12, 2), True),
    (pa.decimal128(10, 2), T.DecimalType(10, 1), False),
    (pa.date32(), T.TimestampNTZType(), True),
    (pa.date32(), T.IntegerType(), False),       # day number, not a value
    (pa.timestamp("us"), T.TimestampType(), True),
    (pa.timestamp("us", tz="UTC"), T.TimestampNTZType(), True),
    (pa.timestamp("ns"), T.TimestampType(), False),
    (pa.binary(), T.StringType(), True),
    (pa.bool_(), T.BooleanType(), True),
])
def test_type_rules(arrow_type, target, ok):
    assert compatible(arrow_type, "", target) is ok


def test_int96_timestamp_accepted():
    assert compatible(pa.timestamp("ns"), "INT96", T.TimestampType())


def test_check_file_statuses(tmp_base):
    put(tmp_base, "0", "good.parquet", [1, 2])
    put(tmp_base, "0", "drift.parquet", [3], pa.string())
    folder = os.path.join(tmp_base, "2024", "1", "1", "0")
    with open(os.path.join(folder, "junk.parquet"), "wb") as f:
        f.write(b"not parquet")
    assert check_file(os.path.join(folder, "good.parquet"), SCHEMA)[1] == OK
    path, status, detail = check_file("file:" + os.path.join(folder, "drift.parquet"), SCHEMA)
    assert status == DRIFT and "id" in detail
    assert check_file(os.path.join(folder, "junk.parquet"), SCHEMA)[1] == UNREADABLE


def test_drifted_file_excluded_reported_or_fatal(spark, tmp_base):
    put(tmp_base, "0", "a.parquet", [1, 2])
    put(tmp_base, "1", "b.parquet", [3])
    put(tmp_base, "1", "c.parquet", [4, 5], pa.string())     # id became text
    # without the check the drifted rows vanish silently
    assert read_incremental(spark, tmp_base, SCHEMA, 2).count() in (3, 5)
    assert sorted(r.id for r in read_incremental(spark, tmp_base, SCHEMA, 2).collect()) == [1, 2, 3]
    skipped = []
    df = read_incremental(spark, tmp_base, SCHEMA, 2, drift="exclude", skipped=skipped)
    assert sorted(r.id for r in df.collect()) == [1, 2, 3]
    assert df.count() == 3                      # the file is not even scanned
    assert len(skipped) == 1 and skipped[0][0].endswith("c.parquet") and skipped[0][1] == DRIFT
    with pytest.raises(ValueError, match="do not match the schema"):
        read_incremental(spark, tmp_base, SCHEMA, 2, drift="error")
    report = []
    read_incremental(spark, tmp_base, SCHEMA, None, drift="report", skipped=report)
    assert len(report) == 1
    # backfill with exclusion reads the remaining files explicitly
    assert read_incremental(spark, tmp_base, SCHEMA, None, drift="exclude").count() == 3


def test_snapshot_with_only_drifted_file_raises(spark, tmp_base):
    put(tmp_base, "0", "a.parquet", [1], pa.string())
    with pytest.raises(ValueError, match="No readable parquet files"):
        read_full_snapshot(spark, tmp_base, SCHEMA, drift="exclude")


def test_load_reports_skipped_files(spark, tmp_base):
    from lakeloom.plans.loads import load_raw_incremental
    from lakeloom.spec import TableSpec
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    folder = os.path.join(tmp_base, "tbl", "2024", "1", "1", "3")
    os.makedirs(folder)
    ts = pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us"))
    pq.write_table(pa.table({"id": pa.array([1], pa.int64()), "ts": ts}), f"{folder}/ok.parquet")
    pq.write_table(pa.table({"id": pa.array([decimal.Decimal(2)], pa.decimal128(38, 0)), "ts": ts}),
                   f"{folder}/wide.parquet")
    spec = TableSpec(target="drift_load", source="tbl", load_type="INCREMENTAL", schema=schema,
                     key=("id",), timestamp="ts", update_op=">=", landing_base=tmp_base)
    with pytest.raises(ValueError, match="do not match the schema"):       # the default
        load_raw_incremental(spark, spec, n_folders=1, record=False)
    spec = spec.with_(schema_drift="exclude")
    r = load_raw_incremental(spark, spec, n_folders=1, record=False)
    assert r.skipped_files == 1 and r.source_rows == 1
    assert [x.id for x in spark.table("drift_load").collect()] == [1]


def test_backfill_exclusion_never_opens_drifted_file(spark, tmp_base):
    put(tmp_base, "0", "a b.parquet", [1, 2])                 # a space: URI-encoded path
    put(tmp_base, "1", "c d.parquet", [3], pa.string())
    skipped = []
    df = read_incremental(spark, tmp_base, SCHEMA, None, drift="exclude", skipped=skipped,
                          ignore_corrupt_files=False)       # opening it would raise
    assert sorted(r.id for r in df.collect()) == [1, 2] and len(skipped) == 1
    assert skipped[0][1] == DRIFT and skipped[0][0].endswith("c d.parquet")


def test_package_shipped_once(spark):
    from lakeloom.session import ship_package
    ship_package(spark)
    ship_package(spark)                      # a second call is a no-op
    assert spark.sparkContext._lakeloom_shipped
    files = spark.sparkContext._jsc.sc().listFiles()
    assert any(str(files.apply(i)).endswith("lakeloom.zip") for i in range(files.size()))


def test_package_shipping_is_thread_safe(spark):
    from concurrent.futures import ThreadPoolExecutor

    from lakeloom.session import ship_package
    spark.sparkContext._lakeloom_shipped = True      # already shipped by an earlier test
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: ship_package(spark), range(8)))


@pytest.mark.parametrize("path", ["hdfs://namenode:8020/lake/2024/1/1/0/a.parquet",
                                  "s3a://bucket/lake/a.parquet", "file:/no/such/dir/a.parquet"])
def test_unreachable_files_are_unchecked_not_dropped(path):
    from lakeloom.sources.drift import UNCHECKED
    assert check_file(path, SCHEMA)[1] == UNCHECKED


def test_only_failing_files_are_excluded(spark, tmp_base):
    from lakeloom.sources.drift import failing_files
    put(tmp_base, "0", "good.parquet", [1])
    good = "file:" + os.path.join(tmp_base, "2024", "1", "1", "0", "good.parquet")
    paths = spark.createDataFrame([(good,), ("hdfs://nn:8020/x/a.parquet",)], "path string")
    assert failing_files(paths, SCHEMA) == ([], 1)       # the second cannot be looked at
