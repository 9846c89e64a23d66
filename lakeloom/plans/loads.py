"""The four load flows, each one Spark plan plus one sink write.

raw  INCREMENTAL: landing (files not in the ledger) -> schema -> prepare -> upsert (>=)
raw  FULL       : landing (newest snapshot)  -> schema -> prepare -> overwrite
clean INCREMENTAL: table -> watermark filter (business time or arrival) -> columns -> prepare -> upsert (>)
clean FULL       : table -> columns -> prepare -> overwrite

``prepare`` = named transforms + latest row per key. When no transform
writes a key, timestamp or tiebreak column, deduplication runs *before* the
transforms: the enrichment join then sees one row per key instead of every
duplicate, and the result is the same because each transform is row-wise
(the lookup side of PRICE_REVENUE is unique per key).
"""

from __future__ import annotations

import logging
import time
from dataclasses import replace
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.transforms import apply_transforms, transform_writes
from lakeloom.operators.dedup import exact_duplicates_removed, latest_per_key
from lakeloom.operators.watermark import after_date_watermark, after_watermark, high_watermark
from lakeloom.sinks.history import append_history
from lakeloom.sinks.tables import LoadResult, get_note, overwrite_table, upsert_table
from lakeloom.sinks.views import rows_table
from lakeloom.sources.landing import ORDER_COL, read_full_snapshot, read_incremental
from lakeloom.sources.ledger import open_ledger, read_new_files
from lakeloom.spec import FULL, INCREMENTAL, TableSpec

log = logging.getLogger("lakeloom.loads")


def prepare(df: DataFrame, spec: TableSpec, extra_tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Transforms and latest-row-per-key, in the cheaper legal order."""
    tiebreak = tuple(spec.tiebreak) + tuple(c for c in extra_tiebreak if c in df.columns)
    if spec.dedups:
        touched = transform_writes(spec)
        ordered = set(spec.key) | {spec.timestamp} | set(tiebreak)
        early = "*" not in touched and not (ordered & touched) and ordered <= set(df.columns)
        if early:
            df = latest_per_key(df, spec.key, spec.timestamp, tiebreak)
            df = apply_transforms(df, spec)
        else:
            df = apply_transforms(df, spec)
            df = latest_per_key(df, spec.key, spec.timestamp, tiebreak)
    else:
        df = apply_transforms(df, spec)
        if spec.dedup_without_timestamp and spec.key:
            df = exact_duplicates_removed(df, spec.key)
    return df.drop(*[c for c in extra_tiebreak if c in df.columns])


def _partitions(spec: TableSpec, df: DataFrame) -> tuple[str, ...] | None:
    if not spec.partition_cols:
        return None
    missing = [c for c in spec.partition_cols if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.target}: partition columns {missing} are neither source "
                         "columns nor produced by a transform")
    return spec.partition_cols


def upsert_scope(spec: TableSpec) -> str:
    return "batch" if spec.fixed_partition else "auto"


def _layout(spec: TableSpec) -> dict:
    return {"stable_view": spec.stable_view, "hash_ranges": spec.hash_ranges}


def _landing(spec: TableSpec) -> str:
    if not spec.landing_base or spec.schema is None:
        raise ValueError(f"{spec.target}: a raw load needs landing_base and schema")
    return f"{spec.landing_base.rstrip('/')}/{spec.source}"


def _finish(spark: SparkSession, result: LoadResult, record: bool,
            skipped: list | None = None) -> LoadResult:
    if skipped:
        result = replace(result, skipped_files=len(skipped))
    if record:
        try:
            append_history(spark, result)
        except Exception as e:  # the table is loaded; a history failure must not undo that
            log.warning("%s loaded, but its history entry was not written: %s", result.table, e)
    log.info("%s %s: source=%d inserted=%d updated=%d", result.operation, result.table,
             result.source_rows, result.inserted, result.updated)
    return result


def _numbered(spark: SparkSession, df: DataFrame, spec: TableSpec, notes: dict[str, str]) -> DataFrame:
    """Stamp a raw batch with its load number, the target's arrival watermark:
    milliseconds, but always above the last load's."""
    if not spec.load_col:
        return df
    number = max(int(time.time() * 1000), int(get_note(spark, spec.target, "load") or 0) + 1)
    notes["load"] = str(number)
    return df.withColumn(spec.load_col, F.lit(number).cast("long"))


def load_raw_incremental(spark: SparkSession, spec: TableSpec, n_folders: int | None = -1,
                         record: bool = True) -> LoadResult:
    """New landing files merged with ``>=``.

    With ``catch_up`` the target keeps a ledger of the files it has taken
    (:mod:`lakeloom.sources.ledger`). The first load reads the ``n_folders``
    newest hour folders; every later one reads the files that the ledger does
    not hold, in whatever folder they arrived, each once. The ledger's entry
    takes effect with the merge, so a job that dies before loads the same files
    again. A file that the footer check leaves out stays open until it is
    mended or removed; it costs a look at its footer a load. Without
    ``catch_up`` every load reads the ``n_folders`` newest folders.
    """
    n = spec.n_folders if n_folders == -1 else n_folders
    landing = _landing(spec)
    order = spec.newest_file_wins and spec.dedups
    skipped: list = []
    notes: dict[str, str] = {}
    read = dict(ignore_corrupt_files=spec.ignore_corrupt_files, with_order=order, drift=spec.schema_drift,
                skipped=skipped)
    ledger = None
    if spec.catch_up:
        ledger = open_ledger(spark, spec.target, landing, lambda key: get_note(spark, spec.target, key))
        df, entry, files = read_new_files(spark, ledger, landing, spec.schema, n, late_days=spec.late_days, **read)
        if df is None:
            return _finish(spark, LoadResult(spec.target, "MERGE", "", 0, partitions_rewritten=0), record, skipped)
        notes[ledger.key] = ledger.write(entry, files)
    else:
        df = read_incremental(spark, landing, spec.schema, n, **read)
    df = _numbered(spark, prepare(df, spec, (ORDER_COL,) if order else ()), spec, notes)
    res = upsert_table(df, spec.target, spec.key, spec.timestamp, spec.update_op,
                       partition_cols=_partitions(spec, df), buckets=spec.buckets,
                       scope=upsert_scope(spec), key_index=spec.key_index, notes=notes,
                       widen=spec.schema_drift == "widen", **_layout(spec))
    if ledger:
        ledger.tidy(notes[ledger.key])
    return _finish(spark, res, record, skipped)


def load_raw_full(spark: SparkSession, spec: TableSpec, record: bool = True) -> LoadResult:
    """Newest finished snapshot, replaced with its schema."""
    order = spec.newest_file_wins and spec.dedups
    skipped: list = []
    notes: dict[str, str] = {}
    df = read_full_snapshot(spark, _landing(spec), spec.schema, spec.snapshot_mode,
                            ignore_corrupt_files=spec.ignore_corrupt_files, with_order=order,
                            drift=spec.schema_drift, skipped=skipped, marker=spec.snapshot_marker,
                            settle=spec.snapshot_settle)
    df = _numbered(spark, prepare(df, spec, (ORDER_COL,) if order else ()), spec, notes)
    res = overwrite_table(df, spec.target, partition_cols=_partitions(spec, df),
                          buckets=spec.buckets, bucket_cols=spec.key, notes=notes, **_layout(spec))
    return _finish(spark, res, record, skipped)


def _source(spark: SparkSession, spec: TableSpec) -> DataFrame:
    df = spark.table(spec.source)
    if spec.columns:
        missing = [c for c in spec.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{spec.source}: columns not found: {missing}")
    return df


def _rows(spark: SparkSession, spec: TableSpec) -> str:
    """The table that holds the target's rows, with its partitions in the catalog."""
    return rows_table(spark, spec.target) or spec.target


def _target_date_partition(spec: TableSpec) -> str | None:
    """The target's ``date`` partition when DERIVE_YMD derives it from the
    watermark column itself (then the newest partition holds the max)."""
    if (spec.partition_cols and "date" in spec.partition_cols
            and "DERIVE_YMD" in spec.active_transforms and spec.ymd_source == spec.timestamp):
        return "date"
    return None


def _newest_arrival(spark: SparkSession, df: DataFrame, spec: TableSpec) -> int | None:
    """Greatest load number of the source: its property, or the column's maximum."""
    listed = spark.catalog.tableExists(spec.source) and spark.catalog.getTable(spec.source).tableType != "TEMPORARY"
    number = get_note(spark, spec.source, "load") if listed else None
    if number is None:
        wm = high_watermark(df, spec.arrival_col)
        number = wm.value if wm else None
    return None if number is None else int(number)


def _arrived(spark: SparkSession, df: DataFrame, spec: TableSpec, notes: dict[str, str]) -> DataFrame | None:
    """F1 by arrival: rows of raw loads that this target has not merged yet,
    whatever their business time; None when there is no such load. The bounds
    are literals, which reach the scan; the upper one keeps out rows of a raw
    load that runs meanwhile. A source that was made anew has other numbers
    than the last one merged, and is read whole if they are smaller."""
    upto = _newest_arrival(spark, df, spec)
    source, _, seen = (get_note(spark, spec.target, "arrival") or "").rpartition("|")
    col = F.col(spec.arrival_col)
    if upto is not None:
        notes["arrival"] = f"{quote(spec.source)}|{upto}"
        if source == quote(spec.source) and int(seen) == upto:
            return None
        if source == quote(spec.source) and int(seen) < upto:
            df = df.filter((col > F.lit(int(seen))) & (col <= F.lit(upto)))
        else:
            df = df.filter(col.isNull() | (col <= F.lit(upto)))
    return df.drop(spec.arrival_col)


def load_clean_incremental(spark: SparkSession, spec: TableSpec, record: bool = True) -> LoadResult:
    """Rows after the target's watermark, merged with ``>``; the target is
    created from the batch when it does not exist yet.

    The watermark is the target's newest business time, or with ``arrival_col``
    the last raw load it has merged: then rows that are late, or edited under an
    old business time, pass as well (the guard decides what they change)."""
    df = _source(spark, spec)
    notes: dict[str, str] = {}
    if spec.arrival_col:
        df = _arrived(spark, df, spec, notes)
        if df is None:
            return _finish(spark, LoadResult(spec.target, "MERGE", "", 0, partitions_rewritten=0), record)
    elif spec.date_watermark_col:
        # when the target is partitioned by that date, only its newest partition is read
        wm = high_watermark(_rows(spark, spec), spec.date_watermark_col, spark,
                            partition_col=spec.date_watermark_col)
        df = after_date_watermark(df, spec.date_watermark_col, wm)
    elif spec.timestamp:
        wm = high_watermark(_rows(spark, spec), spec.timestamp, spark,
                            partition_col=_target_date_partition(spec))
        df = after_watermark(df, spec.timestamp, wm, inclusive=spec.watermark_inclusive,
                             lookback=spec.watermark_lookback, prune_col=spec.prune_partition_col)
    if spec.columns:
        df = df.select(*spec.columns)
    df = prepare(df, spec)
    res = upsert_table(df, spec.target, spec.key, spec.timestamp, spec.update_op,
                       partition_cols=_partitions(spec, df), buckets=spec.buckets,
                       scope=upsert_scope(spec), key_index=spec.key_index, notes=notes,
                       widen=spec.schema_drift == "widen", **_layout(spec))
    return _finish(spark, res, record)


def load_clean_full(spark: SparkSession, spec: TableSpec, record: bool = True) -> LoadResult:
    """R1d: the whole source, replaced."""
    df = _source(spark, spec)
    if spec.columns:
        df = df.select(*spec.columns)
    df = prepare(df, spec)
    res = overwrite_table(df, spec.target, partition_cols=_partitions(spec, df),
                          buckets=spec.buckets, bucket_cols=spec.key, **_layout(spec))
    return _finish(spark, res, record)


def load_table(spark: SparkSession, spec: TableSpec, record: bool = True) -> LoadResult:
    """Dispatch on layer (landing base set = raw) and load type."""
    raw = spec.landing_base is not None
    if spec.load_type == INCREMENTAL:
        return (load_raw_incremental if raw else load_clean_incremental)(spark, spec, record=record)
    if spec.load_type == FULL:
        return (load_raw_full if raw else load_clean_full)(spark, spec, record=record)
    raise ValueError(f"{spec.target}: load type {spec.load_type!r} is neither INCREMENTAL nor FULL")
