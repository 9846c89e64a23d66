"""Keyed stream state: the newest timestamp seen of every key.

A row passes when it is newer than the state of its key, or as new but not one
of the rows the state remembers. What leaves could not change the target: the
upsert keeps the newest row per key, and the row that made the state went to it
before (state and merge belong to one micro-batch, so a failed merge replays
with the state of before). State that is missing (a fresh checkpoint) only lets
more rows pass.

Keys are filed by hash in ``buckets`` buckets, and a bucket's keys are one state
value, which one Python call reads, compares and writes: a micro-batch costs a
call for each bucket it touches, not for each key. A key is known by two 64-bit
hashes. A bucket is read and written whole, so take more buckets where keys
exceed some hundred millions (``state_buckets``). Another number of buckets at the same checkpoint
finds no state for most keys, so it lets more rows pass once.

A hot key is spread: the state is kept per key and ``salt`` values of the row's
hash. A re-delivered row meets the state that its first delivery left; another
row of the key may pass although a newer one went by under another salt, which
the upsert settles. Rows with a NULL in their key always pass, as they always
insert. State lives in RocksDB, so its size is bounded by executors' disks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeloom.session import ship_package

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NEVER = -(1 << 63)
#: Rows of the newest timestamp that the state of a key remembers; of more,
#: re-deliveries pass (and change nothing).
REMEMBERED = 32
#: Buckets of keys.
BUCKETS = 4096
_MARKS = ["_lk_t", "_lk_h", "_lk_k", "_lk_l", "_lk_n", "_lk_b"]


@contextmanager
def state_store(spark: SparkSession):
    """RocksDB for the queries started inside, unless the session names a store."""
    had = spark.conf.get(_STORE, None)
    default = had is None or had.endswith(".HDFSBackedStateStoreProvider")
    if default:
        spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if default:
            spark.conf.unset(_STORE) if had is None else spark.conf.set(_STORE, had)


def _number(ts: str, kind: T.DataType):
    """The timestamp as a long that keeps its order (NULL: the least)."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        n = F.unix_micros(F.col(ts).cast("timestamp"))
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        n = F.col(ts).cast("long")
    else:
        raise ValueError(f"drop_replays needs a date, timestamp or integer column, {ts} is {kind.simpleString()}")
    return F.coalesce(n, F.lit(_NEVER))


def _newer(bucket: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held: dict[tuple[int, int], tuple[int, set[int]]] = {}       # key: newest time, its rows
    if state.exists:
        for k, l, t, h in np.frombuffer(state.get[0], dtype="<i8").reshape(-1, 4).tolist():
            held.setdefault((k, l), (t, set()))[1].add(h)
    new: dict[tuple[int, int], tuple[int, set[int]]] = {}
    for pdf in rows:
        passes = np.ones(len(pdf), dtype=bool)
        for i, (t, h, k, l, null) in enumerate(zip(*(pdf[c].tolist() for c in _MARKS[:5]))):
            if null:
                continue
            had = held.get((k, l))
            if had and (t < had[0] or t == had[0] and h in had[1]):
                passes[i] = False
                continue
            own = new.get((k, l))
            if own is None or t > own[0]:
                own = new[k, l] = (t, set(had[1]) if had and t == had[0] else set())
            if t == own[0]:
                own[1].add(h)
        if passes.any():
            yield pdf[passes].drop(columns=_MARKS)
    if new:
        kept = [(k, l, t, h) for (k, l), (t, known) in (held | new).items() for h in sorted(known)[:REMEMBERED]]
        state.update((np.array(kept, dtype="<i8").tobytes(),))


def newest_only(stream: DataFrame, keys: Sequence[str], ts: str, *, ignore: Sequence[str] = (),
                salt: int = 4, buckets: int = BUCKETS) -> DataFrame:
    """``stream`` without rows that are no newer than earlier ones of their key.
    ``ignore``: columns that a re-delivery may change (its file's name)."""
    ship_package(stream.sparkSession)
    hashed = [F.col(f"`{f.name}`") for f in stream.schema.fields
              if f.name not in ignore and "map<" not in f.dataType.simpleString()]
    # nested values as text: their hash does not tell where one ends
    own = [F.to_json(F.struct(f"`{k}`")) if isinstance(stream.schema[k].dataType, (T.ArrayType, T.StructType))
           else F.col(f"`{k}`") for k in keys]
    null = F.lit(False)
    for k in keys:
        null = null | F.col(f"`{k}`").isNull()
    spread = F.pmod("_lk_h", F.lit(salt))
    marked = stream.withColumns({"_lk_t": _number(ts, stream.schema[ts].dataType), "_lk_h": F.xxhash64(*hashed)}) \
        .withColumns({"_lk_k": F.xxhash64(*own, spread), "_lk_l": F.xxhash64(F.lit(1), *own, spread), "_lk_n": null}) \
        .withColumn("_lk_b", F.pmod(F.when(F.col("_lk_n"), F.col("_lk_h")).otherwise(F.col("_lk_k")),
                                    F.lit(buckets)).cast("int"))
    state = T.StructType([T.StructField("rows", T.BinaryType())])
    return marked.groupBy("_lk_b").applyInPandasWithState(
        _newer, stream.schema, state, "update", GroupStateTimeout.NoTimeout)
