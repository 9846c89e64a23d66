"""Tables as of a load (M5): read a version again, or make it the table's.

Every history entry keeps the definition that its load left: columns, where each
partition lies, and the marks of the loads (ledger entry, arrival, load number,
stream epochs). Version folders never change, so that is enough to read any
entry whose folders :func:`~lakeloom.sinks.tables.prune_versions` has kept.

``restore`` switches the table back without copying a row, as every write
switches it: readers see the old or the restored version. The marks go back with
the rows, so the loads made since then count as not made, and the next one reads
their files or raw rows again (the guard makes repeats harmless; where the
ledger was compacted since, it reads every listed file). A stream with
``drop_replays`` keeps its own state and needs a fresh checkpoint to deliver
those rows again. A bucketed table is written anew from its version, because a
definition over given folders cannot say which bucket a file is.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sinks.history import HISTORY_SCHEMA, VERSION_SCHEMA, append_history, history_path
from lakeloom.sinks.catalog import _ROWS, _STAGE, _exists, _properties, _quote, _siblings, _split
from lakeloom.sinks.tables import LoadResult, _define, _noted, _partition_columns, _swap, heal, write_version
from lakeloom.sinks.views import RANGE, rows_table, switch_view

_AT = "__at_"
_FOLDER = r"/(v_\d+_[0-9a-f]{8})(/|$)"


def versions(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The table's history entries that can be read again, newest first:
    ``version`` (the entry's name), ``ts``, ``operation``, ``rows_written`` and
    the columns of its definition."""
    base = history_path(spark, root)
    fields = [f for f in HISTORY_SCHEMA.fields if f.name != "table_name"] + VERSION_SCHEMA.fields
    schema = T.StructType([*fields, T.StructField("entry", T.StringType())])
    try:
        own = (spark.read.schema(schema).option("basePath", f"{base}/table_name={quote(name, safe='')}")
               .parquet(f"{base}/table_name={quote(name, safe='')}"))
    except Exception as e:  # no load of this table recorded yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        own = spark.createDataFrame([], schema)
    return (own.filter(F.col("columns").isNotNull())
            .select(F.col("entry").alias("version"), "ts", "operation", "rows_written",
                    *VERSION_SCHEMA.fieldNames()).orderBy(F.col("ts").desc(), F.col("version").desc()))


def _entry(spark: SparkSession, name: str, version: str | None, at: dt.datetime | None, root: str | None):
    if (version is None) == (at is None):
        raise ValueError("name a version or a time, not both")
    found = versions(spark, name, root)
    found = found.filter(F.col("version") == version) if at is None else found.filter(F.col("ts") <= F.lit(at))
    row = found.limit(1).collect()
    if not row:
        raise ValueError(f"{name} has no recorded load {'before ' + str(at) if version is None else version}")
    return row[0]


def _kept(spark: SparkSession, name: str, entry) -> None:
    """Raise if folders of the entry have been deleted (one look a version folder)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = {m[0] for x in entry["locations"] if (m := re.match(r"^.*?" + _FOLDER, x["location"]))}
    for folder in sorted(folders):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if not path.getFileSystem(conf).exists(path):
            raise ValueError(f"version {entry['version']} of {name} has been pruned: {folder} is gone")


def _register(spark: SparkSession, definition: str, entry) -> None:
    """Register ``definition`` over the folders of ``entry``."""
    schema = T.StructType.fromJson(json.loads(entry["columns"]))
    parts = tuple(entry["partition_columns"])
    where = {tuple(x["values"]): x["location"] for x in entry["locations"]}
    if parts:
        any_folder = next(iter(where.values()), None) or history_path(spark) + "/_none"
        root = any_folder.rsplit("/", len(parts))[0]
        _define(spark, definition, schema, parts, where, root)
    else:
        _define(spark, definition, schema, (), {}, where[()])


def read_version(spark: SparkSession, name: str, version: str | None = None, *, at: dt.datetime | None = None,
                 root: str | None = None) -> DataFrame:
    """The rows of ``name`` as the load ``version`` left them, or as they were
    at a time. The definition stays registered (``<name>__at_<version>``, one
    catalog entry, no data) until the next prune, so partitions are pruned as in
    the table itself."""
    entry = _entry(spark, name, version, at, root)
    _kept(spark, name, entry)
    db, tbl = _split(name)
    own = f"{db + '.' if db else ''}{tbl}{_AT}{entry['version'][:22]}"
    if not _exists(spark, own):
        _register(spark, own, entry)
    own_rows = spark.table(own)
    return own_rows.drop(RANGE) if "lakeloom.ranges" in (entry["notes"] or {}) else own_rows


def restore(spark: SparkSession, name: str, version: str | None = None, *, at: dt.datetime | None = None,
            marks: bool = True, record: bool = True, root: str | None = None) -> LoadResult:
    """Make the load ``version`` (or the last one before ``at``) the state of
    ``name`` again. With ``marks=False`` the loads since then count as made.
    The restore is a history entry of its own and can be undone like a load."""
    heal(spark, name)
    entry = _entry(spark, name, version, at, root)
    _kept(spark, name, entry)
    now = spark.catalog.listColumns(name) if _exists(spark, name) else []
    notes = dict(entry["notes"] or {}) if marks else {}
    shown = rows_table(spark, name)
    cleared = set(_properties(spark, shown or name)) - set(notes) - {"lakeloom.sink"} if now and marks else set()
    entry_notes = entry["notes"] or {}
    if "lakeloom.ranges" in entry_notes:        # the layout belongs to the rows, not to the marks
        notes["lakeloom.ranges"] = entry_notes["lakeloom.ranges"]
    else:
        cleared.add("lakeloom.ranges")
    notes = {k.removeprefix("lakeloom."): v for k, v in notes.items()}
    path = entry["locations"][0]["location"] if entry["locations"] else ""
    if shown or not now and "lakeloom.shown" in entry_notes:
        rows = f"{name}{_ROWS}{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
        _register(spark, rows, entry)
        switch_view(spark, name, rows, shown, notes, without=cleared)
    elif "lakeloom.ranges" in entry_notes:
        raise ValueError(f"{name} is a plain table now; version {entry['version']} is one of a stable view")
    elif any(c.isBucket for c in now):
        buckets = int(next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(name)}").collect()
                           if r[0] == "Num Buckets"))
        path = write_version(read_version(spark, name, entry["version"], root=root), name, buckets=buckets,
                             partition_cols=_partition_columns(spark, name), notes=notes, root=root,
                             bucket_cols=[c.name for c in now if c.isBucket])
        _unset(spark, name, cleared)
    else:
        db, tbl = _split(name)
        stage = f"{db + '.' if db else ''}{tbl}{_STAGE}{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
        if now:
            _register(spark, stage, entry)
            _swap(spark, name, stage, notes, without=cleared)
        else:                       # the table was dropped; its folders are still there
            _register(spark, name, entry)
            _noted(spark, name, notes)
    spark.catalog.refreshTable(name)
    result = LoadResult(name, "RESTORE", path, 0)
    if record:
        append_history(spark, result, root)
    return result


def _unset(spark: SparkSession, name: str, properties) -> None:
    if properties:
        text = ", ".join(f"'{k}'" for k in sorted(properties))
        spark.sql(f"ALTER TABLE {_quote(name)} UNSET TBLPROPERTIES IF EXISTS ({text})")


def version_folders(spark: SparkSession, name: str, entries: int, root: str | None = None) -> set[str]:
    """Names of the version folders that the ``entries`` newest entries refer to."""
    if entries <= 0:
        return set()
    used = versions(spark, name, root).limit(entries).select(F.explode("locations.location").alias("l"))
    folder = F.regexp_extract("l", _FOLDER, 1)
    return {r["v"] for r in used.select(folder.alias("v")).filter("v <> ''").distinct().collect()}


def drop_definitions(spark: SparkSession, name: str) -> None:
    """Drop the definitions that :func:`read_version` registered (no data)."""
    for left in _siblings(spark, name, _AT):
        spark.sql(f"DROP TABLE IF EXISTS {_quote(left)}")
