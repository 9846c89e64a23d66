"""Timestamp-guarded upsert (J2, M1, M2) and its action counts (A4).

Without a transactional table format the merge is a DataFrame: target FULL
OUTER JOIN source on the business key, one ``when`` per column, and an
``action`` column (``insert`` / ``update`` / ``keep``) that the sink counts
and drops. Semantics:

* matched and ``s.ts > t.ts`` (or ``>=``) -> every source column replaces the
  target's (target-only columns keep their value);
* matched otherwise, including a NULL timestamp on either side -> keep;
* unmatched source row -> insert (target-only columns NULL);
* unmatched target row -> keep; nothing is deleted.

Keys compare with ``=``, so a NULL key never matches and is inserted on every
run. Such rows would all hash to one reducer of the join, and a full outer
join cannot be split by the adaptive skew rule. Two ways around it:

* ``null_keys="salt"`` (default): the join key gets one more column, 0 for a
  row with a key and, for a row with a NULL key, a hash of the whole row
  spread over ``salt_buckets`` values. NULL-key rows still never match but
  land on many reducers, and each side is read once.
* ``null_keys="split"``: NULL-key rows bypass the join through a union
  (target rows kept, source rows inserted); the ``IS NULL`` / ``IS NOT NULL``
  filters reach the Parquet scans. The join then stays keyed by the business
  key alone, which lets a target bucketed by that key join without being
  shuffled; the price is a second, statistics-pruned scan of each side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.widening import wider_type
from lakeloom.spec import as_tuple

INSERT, UPDATE, KEEP = "insert", "update", "keep"
ACTION = "action"


def _any_null(keys: Sequence[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def guarded_upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                   ts: str, op: str = ">", *, action_col: str = ACTION,
                   null_keys: str = "salt", salt_buckets: int = 1024, widen: bool = False) -> DataFrame:
    """Merge ``source`` into ``target``; returns the target's columns plus
    ``action_col``. ``source`` should hold one row per non-NULL key (run
    :func:`~lakeloom.operators.dedup.latest_per_key` first).

    Source values are cast to the target's types; with ``widen`` a column whose
    source type is wider takes the type that holds both."""
    keys = as_tuple(keys)
    if op not in (">", ">="):
        raise ValueError(f"op must be '>' or '>=', got {op!r}")
    if null_keys not in ("salt", "split"):
        raise ValueError(f"null_keys must be 'salt' or 'split', got {null_keys!r}")
    tcols, scols = target.columns, source.columns
    if widen:
        own, new = {f.name: f.dataType for f in target.schema}, {f.name: f.dataType for f in source.schema}
        wide = {c: w for c in tcols if c in new and (w := wider_type(own[c], new[c])) not in (None, own[c])}
        target = target.select(*[F.col(c).cast(wide[c]).alias(c) if c in wide else F.col(c) for c in tcols])
    extra = [c for c in scols if c not in tcols]
    if extra:
        raise ValueError(f"source columns not in target: {extra}")
    for k in (*keys, ts):
        if k not in tcols or k not in scols:
            raise ValueError(f"column {k} must exist in both target and source")

    has_null = _any_null(keys)
    salted = null_keys == "salt"

    def side(df: DataFrame, tag: str) -> DataFrame:
        cols = [F.col(k).alias(f"__{tag}k{i}") for i, k in enumerate(keys)]
        if salted:
            # Spark cannot hash map values; the other columns spread the rows
            hashable = [F.col(f.name) for f in df.schema.fields
                        if "map<" not in f.dataType.simpleString()] or [F.lit(0)]
            spread = F.pmod(F.xxhash64(*hashable), F.lit(salt_buckets)) + 1
            cols.append(F.when(has_null, spread).otherwise(F.lit(0).cast("long"))
                        .alias(f"__{tag}salt"))
        return df.select(*cols, F.struct(*[F.col(c) for c in df.columns]).alias(f"__{tag}"))

    if salted:
        t, s = side(target, "t"), side(source, "s")
    else:
        t, s = side(target.filter(~has_null), "t"), side(source.filter(~has_null), "s")
    cond = [t[f"__tk{i}"] == s[f"__sk{i}"] for i in range(len(keys))]
    if salted:
        cond.append(t["__tsalt"] == s["__ssalt"])
    j = t.join(s, reduce(lambda a, b: a & b, cond), "full")

    tv, sv = F.col("__t"), F.col("__s")
    newer = sv.getField(ts) > tv.getField(ts) if op == ">" else sv.getField(ts) >= tv.getField(ts)
    action = (F.when(tv.isNull(), F.lit(INSERT))
              .when(sv.isNotNull() & newer, F.lit(UPDATE))
              .otherwise(F.lit(KEEP)))
    j = j.withColumn(action_col, action)
    a = F.col(action_col)
    tschema = target.schema
    out = []
    for c in tcols:
        tval = tv.getField(c)
        if c in scols:
            sval = sv.getField(c).cast(tschema[c].dataType)
            out.append(F.when(a == KEEP, tval).otherwise(sval).alias(c))
        else:
            out.append(F.when(a == INSERT, F.lit(None).cast(tschema[c].dataType))
                       .otherwise(tval).alias(c))
    merged = j.select(*out, a)
    if salted:
        return merged
    tschema_cols = [F.col(c) for c in tcols]
    null_target = target.filter(has_null).select(*tschema_cols, F.lit(KEEP).alias(action_col))
    null_source = source.filter(has_null).select(
        *[(F.col(c).cast(tschema[c].dataType) if c in scols
           else F.lit(None).cast(tschema[c].dataType)).alias(c) for c in tcols],
        F.lit(INSERT).alias(action_col))
    return merged.unionByName(null_target).unionByName(null_source)


def action_counts(merged: DataFrame, action_col: str = ACTION) -> DataFrame:
    """A4: rows per action (``action``, ``n``)."""
    return merged.groupBy(action_col).agg(F.count(F.lit(1)).alias("n"))


def metric_columns(action_col: str = ACTION):
    """Aggregates for ``DataFrame.observe``: counted while the merge is
    written, so the metrics need no second pass over the data."""
    a = F.col(action_col)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(a == INSERT, 1).otherwise(0)).alias("inserted"),
        F.sum(F.when(a == UPDATE, 1).otherwise(0)).alias("updated"),
        F.sum(F.when(a == KEEP, 1).otherwise(0)).alias("kept"),
    ]
