"""Key locator: which partitions of a table can hold a batch's keys.

Beside each version folder of a partitioned table, ``_keys/<version>`` holds for
each of its partitions the range of the first key column (integers) and bitmaps
of the hashed keys, in buckets of 32,768 bits over ``SPACE`` values (at most
512 KB a partition). A version never changes, so neither does its index.

An upsert intersects the batch's own bitmaps with those of the partitions that
the table's definition points to. A partition without a common bit, or whose
range ends before the batch's or begins after it, holds none of its keys. Only
the others (with a chance hit now and then) are scanned for the keys themselves.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hash values: a batch of b keys meets a partition of n others by chance in
#: about b * n / SPACE bits.
SPACE = 1 << 22
_VERSION = re.compile(r"^(.*)/(v_\d+_[0-9a-f]{8})(/|$)")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def partition_key(parts: Sequence[str]) -> Column:
    """The partition's values as one text (as its folder spells them)."""
    return F.concat_ws("\u0001", *[F.col(c).cast("string") for c in parts])


def _known(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def _bitmaps(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by, bucket, bits, lo, hi`` of the keys of ``df``."""
    h = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(SPACE))
    first = F.col(keys[0]).cast("long") if isinstance(df.schema[keys[0]].dataType, _WHOLE) else F.lit(None).cast("long")
    return df.filter(_known(keys)).select(*by, h.alias("h"), first.alias("first")) \
        .groupBy(*by, F.bitmap_bucket_number("h").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits"), F.min("first").alias("lo"),
             F.max("first").alias("hi"))


def _index_of(location: str) -> tuple[str, str] | None:
    """Index folder and version of a location inside a version folder."""
    m = _VERSION.match(location)
    return (f"{m[1]}/_keys/{m[2]}", m[2]) if m else None


def write_index(spark: SparkSession, path: str, keys: Sequence[str], parts: Sequence[str], schema: T.StructType) -> None:
    """Index the version folder ``path``."""
    folder, version = _index_of(path)
    own = spark.read.schema(schema).parquet(path)
    _bitmaps(own.withColumn("pk", partition_key(parts)), keys, ["pk"]).withColumn("version", F.lit(version)) \
        .write.mode("errorifexists").parquet(folder)


def holding_partitions(batch: DataFrame, keys: Sequence[str], live: Mapping[str, str]) -> list[str] | None:
    """Those of the partitions ``live`` (key to location) that can hold a key of
    ``batch``; None if a version has no index."""
    spark = batch.sparkSession
    found = {k: _index_of(loc) for k, loc in live.items()}
    if not found or any(v is None for v in found.values()):
        return None
    folders = sorted({f for f, _ in found.values()})
    conf = spark._jsc.hadoopConfiguration()
    for f in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{f}/_SUCCESS")
        if not path.getFileSystem(conf).exists(path):
            return None
    current = spark.createDataFrame([(k, v) for k, (_, v) in found.items()], "pk string, version string")
    own = _bitmaps(batch, keys, []).select("bucket", F.col("bits").alias("mine"), F.col("lo").alias("from"),
                                           F.col("hi").alias("to"))
    span = own.agg(F.min("from").alias("f"), F.max("to").alias("t")).first()
    index = spark.read.schema("pk string, bucket long, bits binary, lo long, hi long, version string").parquet(*folders)
    if span["f"] is not None:
        index = index.filter((F.col("hi") >= span["f"]) & (F.col("lo") <= span["t"]))
    both = index.join(current, ["pk", "version"]).join(own.select("bucket", "mine"), "bucket") \
        .select("pk", "bucket", F.explode(F.array("bits", "mine")).alias("bits"))
    common = both.groupBy("pk", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    return [r["pk"] for r in common.filter("n > 0").select("pk").distinct().collect()]
