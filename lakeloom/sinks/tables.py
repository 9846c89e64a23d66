"""Table write-back without a transactional table format.

Every write goes to a **new version folder**, which is registered as a stage
table; then the old definition is renamed aside, the stage takes its name and
the old definition is dropped last. The folder being read is never the folder
being written, so an upsert can read its own target. A job that dies half way
leaves either the old definition under its name or, between the two renames,
under its set-aside name; the next write to the table puts it back first
(:func:`heal`), so a retry always merges into the previous version and never
creates the table anew. Old versions stay on storage for rollback until
:func:`prune_versions` deletes the folders that no definition refers to.

Only tables of this sink and external Parquet tables are replaced this way.
Any other existing table is refused, except that an upsert into a format with
row-level operations goes to the format's own ``mergeInto``.

Row counts and merge metrics are gathered with ``DataFrame.observe`` during
the write itself: no second job recomputes the plan to count it.

For a partitioned target an upsert rewrites only the partitions it touches
(those holding a key of the batch, plus those receiving new rows): the
touched rows are merged and written under a new version folder, and a stage
definition is made of the new folders and the locations of the untouched
partitions. The same swap by rename follows, so all partitions switch together.
Untouched partitions are neither read nor copied: an hourly batch against a
multi-year table costs a key-only scan of the target plus a rewrite of a few
partitions, not a rewrite of the table.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.upsert import ACTION, INSERT, _any_null, guarded_upsert, metric_columns
from lakeloom.session import warehouse_root
from lakeloom.sinks.catalog import _ASIDE, _ROWS, _STAGE, OWNED, _details, _exists, _properties, _quote, \
    _set_properties, _siblings, _split
from lakeloom.sinks.keys import holding_partitions, partition_key, write_index
from lakeloom.sinks.views import RANGE, layout, layout_note, rows_table, switch_view, with_range
from lakeloom.spec import as_tuple


@dataclass(frozen=True)
class LoadResult:
    table: str
    operation: str          # OVERWRITE | CREATE | MERGE
    path: str
    source_rows: int        # rows of the prepared batch
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    rows_written: int = 0
    partitions_rewritten: int | None = None   # None: whole table written
    skipped_files: int = 0                     # landing files left out by the footer check


def _observed(obs: Observation) -> dict:
    """Metrics of a write; none where the observed rows turned out empty and
    adaptive execution dropped that part of the plan."""
    row = obs._jo.getRow() if getattr(obs, "_jo", None) is not None else None
    return {} if row is not None and row.schema() is None else obs.get


#: Formats without row-level operations.
_FILES = {"parquet", "orc", "csv", "json", "text", "avro", "hive", "binaryfile", "xml"}


def check_target(spark: SparkSession, name: str) -> bool:
    """False for a table whose format merges rows itself; raises for one this
    sink must not replace (neither its own nor external Parquet)."""
    d = _details(spark, name)
    provider, kind = d.get("Provider", "").lower(), d.get("Type", "").upper()
    if provider and provider not in _FILES:
        return False
    if f"{OWNED}=" in d.get("Table Properties", "") or (provider == "parquet" and kind == "EXTERNAL"):
        return True
    raise ValueError(f"{name} is a {kind.lower()} {provider} table that this sink did not create; "
                     "it is left as it is")


def heal(spark: SparkSession, name: str) -> None:
    """Undo a swap that did not finish: the set-aside definition gets its name
    back, left-over stage definitions go (their folders stay)."""
    aside = _siblings(spark, name, _ASIDE)
    if aside and not _exists(spark, name):
        spark.sql(f"ALTER TABLE {_quote(aside[-1])} RENAME TO {_quote(name)}")
        spark.catalog.refreshTable(name)
        aside = aside[:-1]
    for left in [*aside, *_siblings(spark, name, _STAGE)]:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(left)}")


def _swap(spark: SparkSession, name: str, stage: str, notes: Mapping[str, str] | None = None,
          without: Collection[str] = ()) -> None:
    """Give ``stage`` the name: old definition aside, stage in, old one last.
    ``notes`` are set on the stage, so they appear together with its rows; it
    takes the old properties of this package but for those in ``without``."""
    kept = {k: v for k, v in _properties(spark, name).items() if k not in without}
    kept |= {f"lakeloom.{k}": v for k, v in (notes or {}).items()}
    _set_properties(spark, stage, kept)
    tag = _split(stage)[1].rpartition(_STAGE)[2]
    aside = f"{name}{_ASIDE}{tag}"
    spark.sql(f"ALTER TABLE {_quote(name)} RENAME TO {_quote(aside)}")
    spark.sql(f"ALTER TABLE {_quote(stage)} RENAME TO {_quote(name)}")
    spark.sql(f"DROP TABLE {_quote(aside)}")


def _own(spark: SparkSession, name: str) -> None:
    spark.sql(f"ALTER TABLE {_quote(name)} SET TBLPROPERTIES ('{OWNED}' = '1')")


def get_note(spark: SparkSession, name: str, key: str) -> str | None:
    """Table property ``lakeloom.<key>`` of ``name``; swaps keep it."""
    heal(spark, name)
    if not _exists(spark, name):
        return None
    found = _properties(spark, name)
    if "lakeloom.view" in found:
        found = _properties(spark, rows_table(spark, name) or name)
    return found.get(f"lakeloom.{key}")


def set_note(spark: SparkSession, name: str, key: str, value: str) -> None:
    _set_properties(spark, rows_table(spark, name) or name, {f"lakeloom.{key}": value})


def _noted(spark: SparkSession, name: str, notes: Mapping[str, str] | None) -> None:
    """Set notes after a switch that could not carry them; a job that dies
    before only repeats a load that the guard makes harmless."""
    _set_properties(spark, name, {f"lakeloom.{k}": v for k, v in (notes or {}).items()})


def _locations(spark: SparkSession, name: str) -> dict[tuple[str, ...], str]:
    """Location of each registered partition, by its values in column order."""
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(_quote(name))
    parts = _partition_columns(spark, name)
    found = state.catalog().listPartitions(ident, spark._jvm.scala.Option.empty())
    out = {}
    for i in range(found.size()):
        p = found.apply(i)
        out[tuple(p.spec().apply(c) for c in parts)] = p.location().toString()
    return out


def definition(spark: SparkSession, name: str) -> tuple | None:
    """``(columns as JSON, partition columns, [(values, location)], notes)`` of a
    table of this sink, None for any other."""
    if not _exists(spark, name):
        return None
    name = rows_table(spark, name) or name
    d = _details(spark, name)
    if f"{OWNED}=" not in d.get("Table Properties", "") or "Location" not in d:
        return None
    parts = _partition_columns(spark, name)
    if parts and not hasattr(spark, "_jsparkSession"):      # Spark Connect shows no locations
        return None
    where = _locations(spark, name).items() if parts else [((), d["Location"])]
    notes = {k: v for k, v in _properties(spark, name).items() if k != OWNED}
    return spark.table(name).schema.json(), list(parts), [(list(v), loc) for v, loc in where], notes


def prune_versions(spark: SparkSession, name: str, keep: int = 1, root: str | None = None,
                   entries: int = 10) -> list[str]:
    """Delete version folders of ``name`` that neither its definition nor one of
    its ``entries`` newest history entries refers to, but for the ``keep`` newest
    of them; returns the deleted folders. Older entries can then no longer be
    read or restored (:mod:`lakeloom.sinks.versions`)."""
    from lakeloom.sinks.versions import drop_definitions, version_folders
    heal(spark, name)
    kept = version_folders(spark, name, entries, root)
    drop_definitions(spark, name)
    db, tbl = _split(name)
    base = f"{(root or warehouse_root(spark)).rstrip('/')}/{(db + '.') if db else ''}{tbl}"
    live = []
    for held in _siblings(spark, name, _ROWS) if rows_table(spark, name) else [name]:
        live.append(_details(spark, held).get("Location", ""))
        if _partition_columns(spark, held):
            live += _locations(spark, held).values()
    used = kept | {m[1] for x in live if (m := re.search(r"/(v_\d+_[0-9a-f]{8})(/|$)", x))}
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    free = [n for n in names if re.fullmatch(r"v_\d+_[0-9a-f]{8}", n) and n not in used]
    gone = free[:len(free) - keep] if keep else free
    for n in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{n}"), True)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/_keys/{n}"), True)
    return [f"{base}/{n}" for n in gone]


def _merge_into(source: DataFrame, name: str, keys: Sequence[str], ts: str, op: str) -> LoadResult:
    """Upsert by the table format's own row-level merge."""
    n = Observation()
    src = source.observe(n, F.count(F.lit(1)).alias("rows")).alias("source")
    match = None
    for k in keys:
        own = F.col(f"{name}.{k}") == F.col(f"source.{k}")
        match = own if match is None else match & own
    new, old = F.col(f"source.{ts}"), F.col(f"{name}.{ts}")
    (src.mergeInto(name, match).whenMatched(new >= old if op == ">=" else new > old).updateAll()
     .whenNotMatched().insertAll().merge())
    return LoadResult(name, "MERGE", "", int(_observed(n).get("rows", 0)))


def _relocatable(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """An existing external, unpartitioned, unbucketed Parquet table whose
    columns (names and types) equal ``schema``: a new version only has to
    be pointed at, in one catalog call."""
    if not _exists(spark, name):
        return False
    t = spark.catalog.getTable(name)
    if (t.tableType or "").upper() != "EXTERNAL":
        return False
    cols = spark.catalog.listColumns(name)
    if any(c.isPartition or c.isBucket for c in cols):
        return False
    provider = [r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(name)}").collect()
                if r[0] == "Provider"]
    if [p.lower() for p in provider] != ["parquet"]:
        return False
    current = spark.table(name).schema
    return [(f.name, f.dataType) for f in current] == [(f.name, f.dataType) for f in schema]


def write_version(df: DataFrame, name: str, *, partition_cols: Sequence[str] | None = None,
                  buckets: int | None = None, bucket_cols: Sequence[str] = (),
                  root: str | None = None, rebalance: bool = True,
                  notes: Mapping[str, str] | None = None) -> str:
    """Write ``df`` as a new version of table ``name`` and register it.

    ``notes`` become properties ``lakeloom.<key>`` of the table, with the switch.

    ``rebalance`` asks adaptive execution to rebalance rows by the partition
    columns before writing, so each date folder gets a few right-sized files
    instead of one small file per task.

    An existing unpartitioned table with the same columns is switched with
    one ``SET LOCATION`` (readers see the old or the new version, never no
    table). Otherwise the version is registered as a stage table (the write
    registers its partitions) that replaces the old definition (set aside,
    then dropped), which also replaces the schema.
    """
    spark = df.sparkSession
    parts = as_tuple(partition_cols)
    missing = [c for c in parts if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: partition columns not in data: {missing}")
    root = (root or warehouse_root(spark)).rstrip("/")
    db, tbl = _split(name)
    tag = f"{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    path = f"{root}/{(db + '.') if db else ''}{tbl}/v_{tag}"
    stage = f"{db + '.' if db else ''}{tbl}{_STAGE}{tag}"
    heal(spark, name)
    if _exists(spark, name) and not check_target(spark, name):
        raise ValueError(f"{name} has its own table format; write to it with that format")
    if db and not spark.catalog.databaseExists(db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(db)}")
    if not parts and not buckets and _relocatable(spark, name, df.schema):
        df.write.format("parquet").mode("errorifexists").save(path)
        spark.sql(f"ALTER TABLE {_quote(name)} SET LOCATION '{path}'")
        _noted(spark, name, notes)
        spark.catalog.refreshTable(name)
        return path
    if parts and rebalance and not buckets:
        df = df.hint("rebalance", *parts)
    w = df.write.format("parquet").mode("errorifexists").option("path", path)
    if parts:
        w = w.partitionBy(*parts)
    if buckets:
        w = w.bucketBy(buckets, *as_tuple(bucket_cols))
    if not _exists(spark, name):
        # a new table: the catalog entry is created only once the data is written
        w.saveAsTable(name)
        _own(spark, name)
        _noted(spark, name, notes)
        spark.catalog.refreshTable(name)
        return path
    w.saveAsTable(stage)
    _own(spark, stage)
    _swap(spark, name, stage, notes)
    # the write registered the stage's partitions and a rename keeps them; a
    # catalog that drops them on rename gets them back from the folders
    if parts and not spark.sql(f"SHOW PARTITIONS {_quote(name)}").limit(1).collect():
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return path


def overwrite_table(df: DataFrame, name: str, *, partition_cols: Sequence[str] | None = None,
                    buckets: int | None = None, bucket_cols: Sequence[str] = (),
                    root: str | None = None, operation: str = "OVERWRITE",
                    notes: Mapping[str, str] | None = None, stable_view: bool = False,
                    hash_ranges: int | None = None) -> LoadResult:
    """M4/M6: replace data and schema of ``name`` with ``df``. With
    ``stable_view`` or ``hash_ranges`` (of ``bucket_cols``), or where ``name``
    is a view of this sink already, the view is switched
    (:mod:`lakeloom.sinks.views`)."""
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    shown = _view_target(df.sparkSession, name, stable_view or bool(hash_ranges), partition_cols, buckets, hash_ranges)
    if shown is not None:
        stored = layout(df.sparkSession, shown)
        keys = as_tuple(bucket_cols) or (stored[1] if stored else ())
        n_ranges = hash_ranges or (stored[0] if stored and not partition_cols else None)
        if n_ranges and not (keys and set(keys) <= set(df.columns)):
            n_ranges = None
        path = _write_rows(observed, name, shown, partition_cols, keys, n_ranges, root, notes)
        n = int(_observed(obs).get("rows", 0))
        return LoadResult(name, operation, path, n, inserted=n if operation == "CREATE" else 0, rows_written=n)
    path = write_version(observed, name, partition_cols=partition_cols, buckets=buckets,
                         bucket_cols=bucket_cols, root=root, notes=notes)
    n = int(_observed(obs).get("rows", 0))
    return LoadResult(name, operation, path, n, inserted=n if operation == "CREATE" else 0,
                      rows_written=n)


def upsert_table(source: DataFrame, name: str, keys: str | Sequence[str], ts: str,
                 op: str = ">", *, partition_cols: Sequence[str] | None = None,
                 buckets: int | None = None, root: str | None = None,
                 create_if_missing: bool = True, scope: str = "auto",
                 notes: Mapping[str, str] | None = None, key_index: bool = False,
                 widen: bool = False, stable_view: bool = False,
                 hash_ranges: int | None = None) -> LoadResult:
    """M1/M2 (+ M3): merge ``source`` into table ``name`` with the guard
    ``source.ts op target.ts``; create the table from ``source`` when it does
    not exist. A failing merge raises and leaves the target untouched.

    ``scope``: ``"auto"`` rewrites only touched partitions when the target
    is partitioned (and not bucketed), else the whole table; ``"full"``
    always rewrites the whole table; ``"batch"`` is ``"auto"`` for targets
    whose rows never change partition (partition columns derived from an
    immutable column such as a creation time): the touched partitions are
    then the batch's own, and the target is not scanned to find where its
    keys live. With ``"batch"`` a key whose partition did change is inserted
    again instead of updated, so use it only when that cannot happen.

    ``notes`` become properties ``lakeloom.<key>`` of the table, with the switch.
    ``key_index`` keeps bitmaps of each partition's keys beside its version
    (:mod:`lakeloom.sinks.keys`), so that scope ``"auto"`` looks for the
    batch's keys only in partitions that can hold one.
    ``widen``: a column that is wider in ``source`` becomes wider in the target
    (untouched partitions keep their files, which read as the wider type).
    ``stable_view`` makes ``name`` a view over version tables, which one catalog
    call switches; ``hash_ranges`` lays the rows of a target without partition
    columns out in that many ranges of the key's hash, behind such a view, so
    that an upsert reads and rewrites the ranges of its keys only
    (:mod:`lakeloom.sinks.views`). An existing view stays one.
    """
    if scope not in ("auto", "full", "batch"):
        raise ValueError(f"scope must be auto, full or batch, got {scope!r}")
    spark = source.sparkSession
    keys = as_tuple(keys)
    heal(spark, name)
    shown = _view_target(spark, name, stable_view or bool(hash_ranges), partition_cols, buckets, hash_ranges)
    if shown is not None:
        return _upsert_view(source, name, shown, keys, ts, op, partition_cols, hash_ranges, root,
                            create_if_missing, scope, notes, key_index, widen)
    if _exists(spark, name) and not check_target(spark, name):
        res = _merge_into(source, name, keys, ts, op)
        _noted(spark, name, notes)
        return res
    if _exists(spark, name) and scope != "full" and not buckets:
        parts = _partition_columns(spark, name)
        if parts and set(parts) == set(as_tuple(partition_cols) or parts) \
                and _scopable(spark.table(name).schema, parts):
            res = _upsert_partitions(source, name, keys, ts, op, parts, root,
                                     batch_only=scope == "batch", notes=notes, key_index=key_index,
                                     widen=widen)
            if res is not None:
                return res
    src_obs = Observation()
    source = source.observe(src_obs, F.count(F.lit(1)).alias("rows"))
    if not _exists(spark, name):
        if not create_if_missing:
            raise ValueError(f"target table {name} does not exist")
        merged = source.withColumn(ACTION, F.lit(INSERT))
        operation = "CREATE"
    else:
        # a target bucketed by the key keeps its bucketing only if the join is
        # on the key alone: then NULL keys bypass the join instead of salting
        merged = guarded_upsert(spark.table(name), source, keys, ts, op,
                                null_keys="split" if buckets else "salt", widen=widen)
        operation = "MERGE"
    obs = Observation()
    merged = merged.observe(obs, *metric_columns())
    path = write_version(merged.drop(ACTION), name, partition_cols=partition_cols,
                         buckets=buckets, bucket_cols=keys if buckets else (), root=root, notes=notes)
    m = _observed(obs)
    if key_index and partition_cols and not buckets:
        write_index(spark, path, keys, as_tuple(partition_cols), spark.table(name).schema)
    return LoadResult(name, operation, path, int(_observed(src_obs).get("rows", 0)),
                      inserted=int(m.get("inserted") or 0), updated=int(m.get("updated") or 0),
                      deleted=0, rows_written=int(m.get("rows") or 0))


# ---------------------------------------------------------------- stable views
def _view_target(spark: SparkSession, name: str, wanted: bool, partition_cols, buckets: int | None,
                 hash_ranges: int | None) -> str | None:
    """The rows table that the view ``name`` shows, "" for a view to be made,
    None where ``name`` is, or is to be, a plain table."""
    shown = rows_table(spark, name)
    if shown is None and not wanted:
        return None
    if shown is None and _exists(spark, name):
        raise ValueError(f"{name} is a table; a stable view needs a name of its own (or drop the definition)")
    if buckets:
        raise ValueError(f"{name}: a stable view takes hash_ranges instead of buckets")
    if hash_ranges and partition_cols:
        raise ValueError(f"{name}: hash_ranges are for targets without partition columns")
    if hash_ranges is not None and hash_ranges < 1:
        raise ValueError(f"{name}: hash_ranges must be 1 or more")
    return shown or ""


def _write_rows(df: DataFrame, name: str, shown: str, partition_cols: str | Sequence[str] | None,
                keys: Sequence[str], ranges: int | None, root: str | None,
                notes: Mapping[str, str] | None) -> str:
    """Write ``df`` as a whole new version and let the view ``name`` show it."""
    spark = df.sparkSession
    parts = as_tuple(partition_cols)
    if ranges:
        df, parts = with_range(df, keys, ranges), (RANGE,)
        notes = {**(notes or {}), "ranges": layout_note(ranges, keys)}
    missing = [c for c in parts if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: partition columns not in data: {missing}")
    db, tbl = _split(name)
    if db and not spark.catalog.databaseExists(db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(db)}")
    tag = f"{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
    path = f"{(root or warehouse_root(spark)).rstrip('/')}/{(db + '.') if db else ''}{tbl}/v_{tag}"
    w = (df.hint("rebalance", *parts) if parts else df).write.format("parquet").mode("errorifexists")
    w = w.option("path", path)
    rows = f"{name}{_ROWS}{tag}"
    (w.partitionBy(*parts) if parts else w).saveAsTable(rows)
    _own(spark, rows)
    switch_view(spark, name, rows, shown, notes, without=() if ranges else ("lakeloom.ranges",))
    return path


def _upsert_view(source: DataFrame, name: str, shown: str, keys: tuple[str, ...], ts: str, op: str,
                 partition_cols, hash_ranges: int | None, root: str | None, create_if_missing: bool,
                 scope: str, notes: Mapping[str, str] | None, key_index: bool, widen: bool) -> LoadResult:
    """Merge into the rows behind a stable view. A key's range never changes, so
    a target in hash ranges is not looked through for the batch's keys; another
    number of ranges or another key lays the whole table out anew."""
    spark = source.sparkSession
    if not shown and not create_if_missing:
        raise ValueError(f"target table {name} does not exist")
    stored = layout(spark, shown)
    ranges = hash_ranges or (stored[0] if stored and not partition_cols else None)
    if shown and scope != "full":
        schema = spark.table(shown).schema
        parts = _partition_columns(spark, shown)
        if ranges:
            same = stored == (ranges, keys) and all(
                k in source.columns and (schema[k].dataType == source.schema[k].dataType or not widen
                                         or _integral(schema[k].dataType) and _integral(source.schema[k].dataType))
                for k in keys)
            batch = with_range(source, keys, ranges, schema) if same else None
        else:
            same = not stored and bool(parts) and set(parts) == set(as_tuple(partition_cols) or parts) \
                and _scopable(schema, parts)
            batch = source
        if same:
            res = _upsert_partitions(batch, name, keys, ts, op, parts, root, batch_only=bool(ranges) or scope == "batch",
                                     notes=notes, key_index=key_index and not ranges, widen=widen, shown=shown)
            if res is not None:
                return res
    src_obs, obs = Observation(), Observation()
    source = source.observe(src_obs, F.count(F.lit(1)).alias("rows"))
    if shown:
        old = spark.table(shown)
        old = old.drop(RANGE) if stored else old
        merged = guarded_upsert(old, source, keys, ts, op, widen=widen)
        if not ranges and not partition_cols:
            partition_cols = [c for c in _partition_columns(spark, shown) if c != RANGE or not stored]
    else:
        merged = source.withColumn(ACTION, F.lit(INSERT))
    merged = merged.observe(obs, *metric_columns()).drop(ACTION)
    path = _write_rows(merged, name, shown, partition_cols, keys, ranges, root, notes)
    m = _observed(obs)
    if key_index and partition_cols and not ranges:
        write_index(spark, path, keys, as_tuple(partition_cols), spark.table(name).schema)
    return LoadResult(name, "MERGE" if shown else "CREATE", path, int(_observed(src_obs).get("rows", 0)),
                      inserted=int(m.get("inserted") or 0), updated=int(m.get("updated") or 0),
                      rows_written=int(m.get("rows") or 0))


# ---------------------------------------------------------------- partition scope
_SCOPABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.StringType)


def _partition_columns(spark: SparkSession, name: str) -> tuple[str, ...]:
    return tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)


def _integral(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _scopable(schema: T.StructType, parts: Sequence[str]) -> bool:
    return all(isinstance(schema[c].dataType, _SCOPABLE) for c in parts)


def _spec_sql(parts: Sequence[str], values: Sequence, schema: T.StructType) -> str:
    out = []
    for c, v in zip(parts, values):
        t = schema[c].dataType
        if isinstance(t, T.DateType):
            lit = f"DATE'{v}'"
        elif isinstance(t, T.StringType):
            lit = "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        else:
            lit = str(int(v))
        out.append(f"`{c}` = {lit}")
    return "PARTITION (" + ", ".join(out) + ")"


_PLAIN = re.compile(r"^[A-Za-z0-9_.-]*$")


def _define(spark: SparkSession, name: str, schema: T.StructType, parts: Sequence[str],
            where: Mapping[tuple[str, ...], str], path: str) -> None:
    """Register ``name`` over folders that are there: ``path``, or the
    locations ``where`` of its partitions."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)}) " if parts else ""
    spark.sql(f"CREATE TABLE {_quote(name)} ({columns}) USING parquet {by}LOCATION '{path}' "
              f"TBLPROPERTIES ('{OWNED}' = '1')")
    if where:
        spark.sql(f"ALTER TABLE {_quote(name)} ADD " + " ".join(
            f"{_spec_sql(parts, vals, schema)} LOCATION '{loc}'" for vals, loc in where.items()))


def _upsert_partitions(source: DataFrame, name: str, keys: tuple[str, ...], ts: str, op: str,
                       parts: tuple[str, ...], root: str | None,
                       batch_only: bool = False, notes: Mapping[str, str] | None = None,
                       key_index: bool = False, widen: bool = False,
                       shown: str | None = None) -> LoadResult | None:
    """Rewrite only the partitions the batch touches; None -> caller falls
    back to a whole-table rewrite (NULL or unusual partition values).
    ``shown``: the rows table that the stable view ``name`` shows."""
    spark = source.sparkSession
    own_name = shown or name
    target = spark.table(own_name)
    schema = target.schema
    pk = partition_key(parts)
    src = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # the batch's own partitions, with its row count (one pass over the batch)
        touched = src.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
        if not batch_only:
            # partitions holding a key of the batch: key + partition columns only
            nn = ~_any_null(keys)
            own = target
            # the bitmaps hash keys as text, which widening changes for all but integers
            if key_index and all(schema[k].dataType == src.schema[k].dataType
                                 or _integral(schema[k].dataType) and _integral(src.schema[k].dataType) for k in keys):
                live = {"\u0001".join(v): loc for v, loc in _locations(spark, own_name).items()}
                holding = holding_partitions(src, keys, live)
                if holding is not None:
                    own = target.filter(pk.isin(holding))
            touched = touched.unionByName(
                own.select(*keys, *parts).filter(nn)
                .join(src.select(*keys).filter(nn).distinct(), list(keys), "left_semi")
                .select(*parts).distinct().withColumn("_n", F.lit(0).cast("long")))
        touched_rows = (touched.groupBy(*parts).agg(F.sum("_n").alias("_n"))
                        .select(*parts, pk.alias("_pk"), "_n").collect())
        n_src = sum(int(r["_n"]) for r in touched_rows)
        if not touched_rows:
            _noted(spark, own_name, notes)
            return LoadResult(name, "MERGE", "", n_src, partitions_rewritten=0)
        if any(r[c] is None for r in touched_rows for c in parts) or \
                any(not _PLAIN.match(str(r[c])) for r in touched_rows for c in parts):
            return None
        touched = {r["_pk"]: tuple(r[c] for c in parts) for r in touched_rows}
        current = guarded_upsert(target.filter(pk.isin(list(touched))), src, keys, ts, op, widen=widen)
        schema = current.drop(ACTION).schema if widen else schema
        obs = Observation()
        current = current.observe(obs, *metric_columns(), F.collect_set(
            F.struct(pk.alias("_pk"), *[F.col(c) for c in parts])).alias("written_partitions"))
        tag = f"{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}"
        db, tbl = _split(name)
        path = f"{(root or warehouse_root(spark)).rstrip('/')}/{(db + '.') if db else ''}{tbl}/v_{tag}"
        (current.drop(ACTION).hint("rebalance", *parts).write.mode("errorifexists")
         .partitionBy(*parts).parquet(path))
        m = _observed(obs)
    finally:
        src.unpersist()
    if key_index:
        write_index(spark, path, keys, parts, schema)
    written_rows = m.get("written_partitions") or []
    written = {r["_pk"] for r in written_rows}
    # every written partition is switched in, even one the first pass did not
    # name (it cannot happen with a deterministic batch; a lost row would be worse)
    for r in written_rows:
        if r["_pk"] not in touched:
            touched[r["_pk"]] = tuple(r[c] for c in parts)

    def dirname(vals):
        return "/".join(f"{c}={v}" for c, v in zip(parts, vals))

    # the new list of partitions: untouched ones keep their locations
    where = {v: loc for v, loc in _locations(spark, own_name).items()}
    for key, vals in touched.items():
        text = tuple(str(v) for v in vals)
        if key in written:
            where[text] = f"{path}/{dirname(vals)}"
        else:
            where.pop(text, None)
    stage = f"{name}{_ROWS if shown else _STAGE}{tag}"
    _define(spark, stage, schema, parts, where, path)
    if shown:
        switch_view(spark, name, stage, shown, notes)
    else:
        _swap(spark, name, stage, notes)
        spark.catalog.refreshTable(name)
    return LoadResult(name, "MERGE", path, n_src, inserted=int(m.get("inserted") or 0),
                      updated=int(m.get("updated") or 0), deleted=0,
                      rows_written=int(m.get("rows") or 0), partitions_rewritten=len(written))
