"""Helpers shared by the operators: written cuts of the lineage, distributed
running totals, connected components and vectorised text hashing."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.session import scratch_path, ship_package

#: Rows of one Arrow batch handed to Python; texts can be long.
ARROW_ROWS = 1024
#: Bytes of text that the vectorised kernels work on at once (a longer single
#: text is worked on alone).
CHUNK_BYTES = 2 << 20

M64 = (1 << 64) - 1


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and keep Arrow batches small."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- running totals in a global order -------------------------------------

def range_parts(df: DataFrame, rows: int | None = None, per_part: int = 1_000_000) -> int:
    """Range partitions: the shuffle setting, more where rows are many."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, -(-(rows or 0) // per_part))


def range_buckets(df: DataFrame, order: list[Column], name: str, rows: int | None = None) -> DataFrame:
    """Cut ``df`` into ranges of ``order`` and name each row's range in
    ``_bucket`` (ascending). Written, so that every later use sees the same
    ranges."""
    cut = df.repartitionByRange(range_parts(df, rows), *order)
    return written(cut.withColumn("_bucket", F.spark_partition_id()), name)


def running_before(df: DataFrame, group: list[str], order: list[Column], value: str,
                   out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows of the group that come
    earlier in ``(_bucket, order)``.

    Two steps, so that no task holds a whole group: the sums of the buckets
    are accumulated over the few buckets, rows only within their bucket.
    """
    sums = df.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*group, "_bucket", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*group, "_bucket").orderBy(*order)
    own = df.withColumn("_own", F.sum(value).over(
        inner.rowsBetween(Window.unboundedPreceding, -1)))
    cond = functools.reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
                                                 for c in [*group, "_bucket"]])
    return own.alias("l").join(base.alias("r"), cond, "left").select(
        "l.*", (F.coalesce(F.col("l._own"), F.lit(0)) + F.col("r._base")).alias(out)).drop("_own")


def numbered(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """``_n, _t`` with one row per document and ``_n`` in the order of
    documents; and None, or ``_n, _id, _h, _rows`` where doc_ids are null or
    repeated. Rows that repeat doc_id and text are one document."""
    own = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_t"))
    n, named, different = own.agg(F.count("*"), F.count("_id"), F.countDistinct("_id")).head()
    if n == named == different:
        return own.select(F.col("_id").alias("_n"), "_t"), None
    own = own.withColumn("_h", F.xxhash64(F.coalesce("_t", F.lit(""))))
    keys = own.groupBy("_id", "_h").agg(F.count("*").alias("_rows"))
    order = [F.col("_id").asc_nulls_last(), F.col("_h")]
    held = range_buckets(written(keys, f"{name}-keys"), order, f"{name}-order").withColumn("_one", F.lit(1).cast("long"))
    names = written(running_before(held, [], order, "_one", "_n").select("_n", "_id", "_h", "_rows"), f"{name}-names")
    one = own.dropDuplicates(["_id", "_h"]).alias("d").join(
        names.alias("k"), F.col("d._id").eqNullSafe(F.col("k._id")) & (F.col("d._h") == F.col("k._h"))) \
        .select("k._n", "d._t")
    return written(one, f"{name}-docs"), names


# --- connected components -------------------------------------------------

def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)``: root is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours and
    itself, then the label of that label (pointer jumping); edges inside one
    component leave. Labels and remaining edges are written each round, so a
    round never re-runs an earlier one. Rounds grow with the logarithm of the
    longest path; nothing but a row count reaches the driver.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), f"{name}-edges")
    labels = written(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                     .withColumn("root", F.col("node")), f"{name}-labels")
    live = edges
    for _ in range(max_rounds):
        if live.isEmpty():
            return labels
        best = live.select(F.col("a").alias("n"), F.col("b").alias("m")) \
            .union(live.select("b", "a")).groupBy("n").agg(F.min("m").alias("m")) \
            .select("n", F.least("n", "m").alias("p"))
        # live edges join labels of this round (roots); point each root at its
        # smallest neighbouring root, then jump twice
        best = written(best, f"{name}-best")
        b1, b2, b3 = best.alias("b1"), best.alias("b2"), best.alias("b3")
        jump = b1.join(b2, F.col("b1.p") == F.col("b2.n"), "left") \
            .select(F.col("b1.n").alias("n"),
                    F.coalesce(F.col("b2.p"), F.col("b1.p")).alias("p")).alias("j")
        jump = jump.join(b3, F.col("j.p") == F.col("b3.n"), "left") \
            .select(F.col("j.n").alias("n"), F.coalesce(F.col("b3.p"), F.col("j.p")).alias("p"))
        jump = written(jump, f"{name}-jump")
        j1, j2 = jump.alias("j1"), jump.alias("j2")
        labels = written(
            labels.alias("l").join(j1, F.col("l.root") == F.col("j1.n"), "left")
            .select(F.col("l.node").alias("node"),
                    F.coalesce(F.col("j1.p"), F.col("l.root")).alias("root")), f"{name}-labels")
        live = written(
            live.alias("e").join(j1, F.col("e.a") == F.col("j1.n"))
            .select(F.col("j1.p").alias("a"), F.col("e.b").alias("b")).alias("f")
            .join(j2, F.col("f.b") == F.col("j2.n"))
            .select(F.least("f.a", "j2.p").alias("a"), F.greatest("f.a", "j2.p").alias("b"))
            .filter("a <> b").distinct(), f"{name}-live")
    raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")


# --- comparing within groups, in tiles ---------------------------------------

def tiled(rows: DataFrame, group: str, ident: str, block: int) -> DataFrame:
    """Deal each group's rows to tiles of two blocks: every two rows of a
    group meet in exactly one tile ``(group, i, j)``, where ``mine`` is the
    row's own block. Blocks hold about ``block`` rows, or the root of the
    group's size where that is more."""
    size = rows.groupBy(group).agg(F.count("*").alias("_size"))
    blocks = F.ceil(F.col("_size") / F.greatest(F.lit(block), F.ceil(F.sqrt("_size")))).cast("int")
    own = rows.join(size, group).withColumn("_blocks", blocks) \
        .withColumn("mine", F.pmod(F.xxhash64(ident), F.col("_blocks")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return own.withColumns({"i": F.least("mine", "_other"), "j": F.greatest("mine", "_other")}) \
        .drop("_size", "_blocks", "_other")


def runs(batches, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal integer ``keys``, with the runs' edges (first 0, last the row count)."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        if not t.num_rows:
            continue
        new = np.zeros(t.num_rows, dtype=bool)
        for k in keys:
            v = t[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        edge = np.flatnonzero(new)
        if len(edge):
            yield t.slice(0, int(edge[-1])), np.concatenate([[0], edge])
            held = t.slice(int(edge[-1]))
        else:
            held = t
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


# --- vectorised text kernels ----------------------------------------------

def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (SplitMix64's finaliser)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@functools.lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    have, step = 1, np.uint64(base)
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * step
        have += take
        step = step * step
    return out


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64 (at least ``n`` of them)."""
    return _powers(base, 1 << max(10, math.ceil(math.log2(max(n, 2)))))[:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2^64 of ``values[start:end]`` per range, mixed."""
    n = len(values)
    with np.errstate(over="ignore"):
        pre = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, n), out=pre[1:])
        return splitmix((pre[ends] - pre[starts]) * powers(_INV, n + 1)[starts])


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string array (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    arr = arr.cast(pa.large_string())
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if len(arr) == 0 or arr.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(arr) + 1, dtype=np.int64)
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` of consecutive rows of about ``limit`` bytes."""
    data, offs = string_bytes(arr)
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def regrouped(batches, column: str, limit: int = 4 * CHUNK_BYTES) -> Iterator[pa.Table]:
    """Join small Arrow batches and split large ones to about ``limit`` bytes
    of text in ``column`` (at least one row)."""
    held, size = [], 0
    for b in batches:
        own = b.column(column).nbytes
        if held and size + own > limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        if own > limit and b.num_rows > 1:
            _, offs = string_bytes(b.column(column))
            i = 0
            while i < b.num_rows:
                j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
                j = min(b.num_rows, max(j, i + 1))
                yield pa.Table.from_batches([b.slice(i, j - i)])
                i = j
        else:
            held.append(b)
            size += own
    if held:
        yield pa.Table.from_batches(held)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the rows of one chunk.

    ``start``/``end``: byte range of each word; ``first``: index of each
    row's first word (one more entry closes the last row).
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        word = np.zeros(len(data) + 2, dtype=bool)
        np.logical_not(_SPACE[data], out=word[1:-1])
        inner = word[1:-1]
        begin = inner & ~word[:-2]
        stop = inner & ~word[2:]
        cut = offs[(offs > 0) & (offs < len(data))]
        begin[cut] = inner[cut]                      # a row's end ends a word
        stop[cut - 1] = inner[cut - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offs, side="left")
        self.count = np.diff(self.first)
        self.data = data

    def hashes(self) -> np.ndarray:
        return range_hashes(_BYTE[self.data], self.start, self.end)


def gram_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a row, and how many each row
    has. A row of 1 to k-1 words has one run: all its words."""
    n = np.diff(first)
    grams = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), grams)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
    starts = first[:-1][row] + pos
    return range_hashes(words, starts, starts + np.minimum(n[row], k)), grams
