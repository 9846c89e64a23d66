"""Wider landing files make the columns wider; nothing is dropped or lost."""

import datetime as dt
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.widening import wider_type
from lakeloom.plans.loads import load_raw_incremental
from lakeloom.sinks.tables import upsert_table
from lakeloom.sources.landing import read_incremental
from lakeloom.spec import TableSpec

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("x", T.FloatType()), T.StructField("p", T.StringType())])
BIG = 1 << 40


def put(base, hour, ids, id_type, x_type=pa.float32(), p="a", x=0.1):
    folder = os.path.join(base, "t", "2024", "1", "1", str(hour))
    os.makedirs(folder, exist_ok=True)
    n = len(ids)
    pq.write_table(pa.table({"id": pa.array(ids, id_type), "x": pa.array([x] * n).cast(x_type),
                             "ts": pa.array([dt.datetime(2024, 1, 1, hour)] * n, pa.timestamp("us")),
                             "p": [p] * n}), os.path.join(folder, f"{uuid.uuid4().hex}.parquet"))


@pytest.mark.parametrize("a,b,want", [
    (T.IntegerType(), T.LongType(), T.LongType()),
    (T.ByteType(), T.ShortType(), T.ShortType()),
    (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (T.IntegerType(), T.FloatType(), T.DoubleType()),
    (T.LongType(), T.DoubleType(), None),
    (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)),
    (T.IntegerType(), T.DecimalType(5, 2), T.DecimalType(12, 2)),
    (T.DecimalType(38, 0), T.DecimalType(10, 5), None),
    (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
    (T.StringType(), T.LongType(), None),
])
def test_wider_type(a, b, want):
    assert wider_type(a, b) == want and wider_type(b, a) == want


def test_mixed_files_read_whole(spark, tmp_base):
    put(tmp_base, 0, [1, 2], pa.int32())
    put(tmp_base, 1, [BIG, None], pa.int64())
    put(tmp_base, 2, [5], pa.int32(), pa.float64())
    df = read_incremental(spark, f"{tmp_base}/t", SCHEMA, None, drift="widen")
    assert [f.dataType for f in df.schema][:3] == [T.LongType(), T.TimestampNTZType(), T.DoubleType()]
    got = {(r.id, r.x) for r in df.collect()}
    f32 = pa.scalar(0.1, pa.float32()).as_py()
    assert got == {(1, f32), (2, f32), (BIG, f32), (None, f32), (5, 0.1)}
    with pytest.raises(ValueError, match="do not match"):
        read_incremental(spark, f"{tmp_base}/t", SCHEMA, None, drift="error")
    put(tmp_base, 3, ["7"], pa.string())
    with pytest.raises(ValueError, match="do not match"):
        read_incremental(spark, f"{tmp_base}/t", SCHEMA, None, drift="widen")


def test_files_without_a_common_type_fail(spark, tmp_base):
    put(tmp_base, 0, [1], pa.int64())
    put(tmp_base, 1, [1], pa.float64())
    with pytest.raises(ValueError, match="without loss"):
        read_incremental(spark, f"{tmp_base}/t", SCHEMA, None, drift="widen")


@pytest.mark.parametrize("parts", [None, ("p",)])
def test_the_target_widens_and_keeps_its_partitions(spark, tmp_base, parts):
    spec = TableSpec(target=f"widened_{uuid.uuid4().hex[:8]}", source="t", load_type="INCREMENTAL", schema=SCHEMA,
                     key=("id",), timestamp="ts", landing_base=tmp_base, partition_cols=parts, update_op=">=",
                     schema_drift="widen", n_folders=None, key_index=parts is not None)
    put(tmp_base, 0, [1, 2], pa.int32())
    put(tmp_base, 0, [3], pa.int32(), p="b")
    load_raw_incremental(spark, spec)
    put(tmp_base, 1, [BIG, 2], pa.int64(), pa.float64(), x=0.5)
    res = load_raw_incremental(spark, spec)
    assert res.partitions_rewritten == (1 if parts else None)
    put(tmp_base, 2, [3], pa.int32(), p="b", x=2.0)        # narrow again: cast up
    load_raw_incremental(spark, spec)
    t = spark.table(spec.target)
    assert t.schema["id"].dataType == T.LongType() and t.schema["x"].dataType == T.DoubleType()
    f32 = pa.scalar(0.1, pa.float32()).as_py()
    assert {(r.id, r.x, r.p) for r in t.collect()} == {(1, f32, "a"), (2, 0.5, "a"), (BIG, 0.5, "a"), (3, 2.0, "b")}


def test_without_widen_values_are_cast_to_the_target(spark):
    name = f"narrow_{uuid.uuid4().hex[:8]}"
    make = lambda t: spark.range(3).select(F.col("id").cast(t).alias("k"), F.lit(1).alias("n"))
    upsert_table(make("int"), name, ["k"], "n", ">=")
    upsert_table(make("long"), name, ["k"], "n", ">=")
    assert spark.table(name).schema["k"].dataType == T.IntegerType()
    upsert_table(make("long"), name, ["k"], "n", ">=", widen=True)
    assert spark.table(name).schema["k"].dataType == T.LongType() and spark.table(name).count() == 3
