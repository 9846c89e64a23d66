"""Latest row per business key (W1) and latest attribute per lookup key.

Both are ``row_number() OVER (PARTITION BY key ORDER BY ts DESC ...) = 1``.
Written that way Catalyst inserts a *partial* ``WindowGroupLimit`` before the
shuffle: every map task forwards at most one row per key, so a key holding a
third of all rows costs one row per task in the exchange, not a third of the
data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeloom.spec import as_tuple

_RN = "__lakeloom_rn"


def normalise_timestamp(df: DataFrame, ts: str) -> DataFrame:
    """Give the ordering column a timestamp type before ranking.

    Timestamps (with or without time zone) are kept; a date becomes
    ``timestamp_ntz`` (midnight, no zone shift); strings are parsed.
    """
    dtype = df.schema[ts].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return df
    if isinstance(dtype, T.DateType):
        return df.withColumn(ts, F.col(ts).cast(T.TimestampNTZType()))
    return df.withColumn(ts, F.col(ts).cast(T.TimestampType()))


def _orderable(dtype: T.DataType) -> bool:
    return "map<" not in dtype.simpleString()


def latest_per_key(df: DataFrame, keys: str | Sequence[str], ts: str,
                   tiebreak: str | Sequence[str] = (), *, normalise: bool = True) -> DataFrame:
    """Keep the newest row of each key.

    Order: ``ts DESC NULLS LAST``, then each tiebreak column descending, then
    every other column (except maps, which Spark cannot order) descending. A
    row with a timestamp beats a NULL one, and the choice among tied rows is
    a function of the rows alone. So a recomputation (a lost cached block,
    a retried stage) picks the same row, which the partition-scoped upsert
    relies on. The extra columns are compared only between rows that tie on
    everything before them. NULL keys form one group, as in a window partition.
    """
    keys = as_tuple(keys)
    if not keys:
        raise ValueError("latest_per_key needs at least one key column")
    if normalise:
        df = normalise_timestamp(df, ts)
    tiebreak = as_tuple(tiebreak)
    rest = [f.name for f in df.schema.fields
            if f.name not in (*keys, ts, *tiebreak) and _orderable(f.dataType)]
    order = [F.col(c).desc_nulls_last() for c in (ts, *tiebreak, *rest)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def exact_duplicates_removed(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Opt-in dedup when there is no timestamp: one row per key (or per full
    row, a hash aggregate with map-side combine). Rows of a key that differ
    are ranked by their other columns, so the kept row is the same on every
    evaluation (``dropDuplicates`` on a key keeps whichever row comes first)."""
    if not keys:
        return df.dropDuplicates()
    keys = as_tuple(keys)
    order = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    if not order:
        return df.dropDuplicates(list(keys))
    return latest_per_key(df, keys, order[0], order[1:], normalise=False)


def latest_value(df: DataFrame, key: str, value_col: str, order_col: str,
                 tiebreak: Sequence[str] = (), alias: str | None = None) -> DataFrame:
    """W2 + P10: ``(key, value AS alias)`` from each key's newest row.

    Rows with a NULL key are dropped first: an equality join can never match
    them, so ranking them would only cost a shuffle.
    """
    cols = list(dict.fromkeys([key, value_col, order_col, *tiebreak]))
    ranked = latest_per_key(df.select(*cols).filter(F.col(key).isNotNull()),
                            [key], order_col, tiebreak)
    return ranked.select(F.col(key), F.col(value_col).alias(alias or value_col))
