"""Load history (M5) and its newest entries.

One row per load is appended to a Parquet folder under the warehouse root:
``(table_name, ts, operation, source_rows, inserted, updated, deleted,
rows_written, path, skipped_files, partitions_rewritten)``, partitioned by
``table_name`` so that one table's entries are read without listing or
opening the others' files (an hourly load of many tables adds thousands of
entries a year). Each entry is written to its own ``entry=<tag>`` folder:
appends from concurrent loads (threads of one run, or separate jobs) never
share a job's temporary output folder, which appends into one shared folder
do. Reading the newest entry per table is the same latest-row-per-key
operator the loads use. Each entry also keeps the definition that its load left
(:data:`VERSION_SCHEMA`), which :mod:`lakeloom.sinks.versions` reads and restores;
those columns are pruned from every other read.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.dedup import latest_per_key
from lakeloom.session import warehouse_root
from lakeloom.sinks.tables import LoadResult, definition

HISTORY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("source_rows", T.LongType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("deleted", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("skipped_files", T.LongType()),
    T.StructField("partitions_rewritten", T.LongType()),   # NULL: the whole table
])


def history_path(spark: SparkSession, root: str | None = None) -> str:
    return f"{(root or warehouse_root(spark)).rstrip('/')}/_load_history"


#: What an entry keeps to read its version again: the table's columns, its
#: partition columns, where its data lies (of a partition, by its values) and
#: the marks that loads keep in its properties. NULL for tables of other formats.
VERSION_SCHEMA = T.StructType([
    T.StructField("columns", T.StringType()),
    T.StructField("partition_columns", T.ArrayType(T.StringType())),
    T.StructField("locations", T.ArrayType(T.StructType([
        T.StructField("values", T.ArrayType(T.StringType())), T.StructField("location", T.StringType())]))),
    T.StructField("notes", T.MapType(T.StringType(), T.StringType())),
])


def append_history(spark: SparkSession, result: LoadResult, root: str | None = None) -> str:
    """Record a load together with the definition it left; returns the entry's name."""
    row = (result.table, dt.datetime.now(dt.timezone.utc), result.operation, result.source_rows,
           result.inserted, result.updated, result.deleted, result.rows_written, result.path,
           result.skipped_files, result.partitions_rewritten)
    tag = f"{int(time.time() * 1000)}_{uuid.uuid4().hex[:12]}"
    folder = f"{history_path(spark, root)}/table_name={quote(result.table, safe='')}/entry={tag}"
    now = definition(spark, result.table) or (None,) * len(VERSION_SCHEMA.fields)
    (spark.createDataFrame([(*row, *now)], T.StructType(HISTORY_SCHEMA.fields + VERSION_SCHEMA.fields))
     .drop("table_name").coalesce(1).write.mode("errorifexists").parquet(folder))
    return tag


def read_history(spark: SparkSession, root: str | None = None) -> DataFrame:
    try:
        return (spark.read.schema(HISTORY_SCHEMA).parquet(history_path(spark, root))
                .select(*HISTORY_SCHEMA.fieldNames()))
    except Exception as e:  # no load recorded yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], HISTORY_SCHEMA)
        raise


def latest_entries(history: DataFrame, table_col: str = "table_name", ts_col: str = "ts",
                   tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The newest history entry of every table."""
    return latest_per_key(history, [table_col], ts_col, tiebreak, normalise=False)


def last_load(spark: SparkSession, table: str, root: str | None = None) -> dict | None:
    """M5: inserted / updated / deleted of the table's last load, or None.

    Reads one table's entries, takes the newest (``ORDER BY ts DESC LIMIT 1``)
    and returns it as a dict; missing metrics read as 0.
    """
    rows = (table_history(spark, table, root)
            .orderBy(F.col("ts").desc()).limit(1).collect())
    if not rows:
        return None
    r = rows[0].asDict()
    for k in ("inserted", "updated", "deleted"):
        r[k] = int(r.get(k) or 0)
    return r


def table_history(spark: SparkSession, table: str, root: str | None = None) -> DataFrame:
    """Every recorded load of ``table``, newest first (the history of one
    table; reads only that table's history partition)."""
    base = history_path(spark, root)
    try:        # list this table's folder only
        own = (spark.read.schema(HISTORY_SCHEMA).option("basePath", base)
               .parquet(f"{base}/table_name={quote(table, safe='')}"))
    except Exception as e:  # no load of this table recorded yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], HISTORY_SCHEMA)
        raise
    return (own.filter(F.col("table_name") == table).select(*HISTORY_SCHEMA.fieldNames())
            .orderBy(F.col("ts").desc()))


def history_view(spark: SparkSession, view: str = "load_history", root: str | None = None) -> str:
    """Expose the load history to SQL as a temporary view; returns its name."""
    read_history(spark, root).createOrReplaceTempView(view)
    return view
