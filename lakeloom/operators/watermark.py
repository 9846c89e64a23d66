"""High watermark (A1) and incremental filters (F1, F2).

The watermark is one aggregate row (partial max per task, one final row), and
it comes back to the driver as a *literal*: a filter ``ts > literal`` reaches
the Parquet scan as a pushed predicate, which a join against the aggregate
would not. The literal is carried as text and cast to the column's own type,
so a timestamp without time zone never passes through a Python datetime.

On a large target ``max(ts)`` is a scan of the whole column. When the target
is partitioned by a date derived from ``ts`` itself (DERIVE_YMD), the maximum
lies in the newest date partition: that partition is found in the catalog's
partition list (no file is read) and only it is scanned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARTITION_TYPES = (T.DateType, T.IntegerType, T.LongType, T.ShortType, T.ByteType)


@dataclass(frozen=True)
class Watermark:
    value: Any          # Python value of max(col)
    text: str           # the same value rendered by Spark, for literals
    column: str


def watermark_frame(df: DataFrame, column: str, alias: str = "watermark") -> DataFrame:
    """``SELECT max(column) AS watermark`` as a one-row DataFrame."""
    return df.agg(F.max(F.col(column)).alias(alias))


def newest_partition(spark: SparkSession, table: str, column: str):
    """Greatest value of partition column ``column`` of ``table`` from the
    catalog's partition list, or None (not a date / integer partition column,
    no partition, only the NULL partition). Reads no data file."""
    schema = spark.table(table).schema
    part_cols = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    if column not in part_cols or not isinstance(schema[column].dataType, _PARTITION_TYPES):
        return None
    quoted = ".".join(f"`{p}`" for p in table.split("."))
    value = F.regexp_extract("partition", rf"(?:^|/){re.escape(column)}=([^/]*)", 1)
    row = (spark.sql(f"SHOW PARTITIONS {quoted}")
           .agg(F.max(value.try_cast(schema[column].dataType)).alias("v")).first())
    return None if row is None else row["v"]


def high_watermark(source: DataFrame | str, column: str,
                   spark: SparkSession | None = None, *,
                   partition_col: str | None = None) -> Watermark | None:
    """Max of ``column`` in a DataFrame or catalog table.

    A missing table, an empty table and an all-NULL column all mean "no
    watermark" (``None``); other errors propagate instead of silently
    turning the load into a full reload.

    ``partition_col``: a date (or integer) partition column of the table whose
    value grows with ``column`` (e.g. ``date = to_date(ts)``). Then only the
    newest partition is scanned; if it holds no non-NULL ``column`` the
    whole table is.
    """
    if isinstance(source, str):
        if spark is None:
            raise ValueError("a SparkSession is needed to read a table by name")
        if not spark.catalog.tableExists(source):
            return None
        df = spark.table(source)
        if partition_col:
            newest = newest_partition(spark, source, partition_col)
            if newest is not None:
                wm = _max(df.filter(F.col(partition_col) >= F.lit(newest)), column)
                if wm is not None:
                    return wm
    else:
        df = source
    return _max(df, column)


def _max(df: DataFrame, column: str) -> Watermark | None:
    if column not in df.columns:
        raise ValueError(f"watermark column {column} not in {df.columns}")
    c = F.col(column)
    row = df.agg(F.max(c).alias("v"), F.max(c).cast("string").alias("t")).first()
    if row is None or row["v"] is None:
        return None
    return Watermark(row["v"], row["t"], column)


def after_watermark(df: DataFrame, column: str, wm: Watermark | None, *,
                    inclusive: bool = False, lookback: str | None = None,
                    prune_col: str | None = None) -> DataFrame:
    """keep rows with ``column > watermark`` (``>=`` when inclusive).

    No watermark keeps everything. Rows with a NULL ``column`` are dropped
    once a watermark exists. ``lookback`` (e.g. ``"1 hour"``) moves the bound
    back to re-read late rows; the upsert guard then resolves the overlap.

    ``prune_col`` names a *date* partition column of ``df`` derived from
    ``column``; adding ``prune_col >= to_date(bound)`` lets the scan skip
    whole partitions, which the timestamp predicate alone does not.
    """
    if wm is None:
        return df
    dtype = df.schema[column].dataType
    bound = F.lit(wm.text).cast(dtype)
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    cond = F.col(column) >= bound if inclusive else F.col(column) > bound
    if prune_col:
        cond = cond & (F.col(prune_col) >= F.to_date(bound))
    return df.filter(cond)


def after_date_watermark(df: DataFrame, date_col: str, wm: Watermark | None) -> DataFrame:
    """keep rows whose date partition is strictly after the last loaded
    date (prunes partitions directly)."""
    if wm is None:
        return df
    return df.filter(F.col(date_col) > F.lit(wm.text).cast(df.schema[date_col].dataType))
