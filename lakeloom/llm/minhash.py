"""Near-duplicate documents by ProbMinHash.

A document is its weighted set of word shingles (``SHINGLE`` words, weight =
how often it occurs). Each shingle sends out a Poisson process whose rate is
its weight; every arrival goes to a random one of ``REGISTERS`` registers, and
a register keeps the shingle that arrived first. Arrivals end as soon as they
are later than every register's first one. Two registers agree with
probability equal to the probability Jaccard similarity of the documents. The
same with all weights 1 gives a second family of registers, which agree with
probability equal to the plain Jaccard similarity; a document whose shingles
all occur equally often has the same registers in both.

Bands of registers of both families file documents into buckets. In each bucket every document
is compared with the bucket's first one; afterwards only documents of one
bucket that are still in different groups are compared, in tiles that judge
their pairs and return the links that join groups. A pair is first judged by its
registers (only those far below the threshold in both families leave) and then
exactly, on its shingles (44 bits of hash, weights up to 1,048,575): it is linked
when its probability Jaccard or its plain Jaccard similarity is at least
``THRESHOLD``. Groups are connected components; the
smallest doc_id names a group and is the document that stays.

Exact copies are folded first, by hash, so a group of copies of any size costs
one row per copy. Words are ``[^\\x20\\x09-\\x0D]+``; a text of 1 to 4 words is
one shingle. Null texts and texts without words are linked with nothing. Rows
that repeat doc_id and text are one document, returned as often as they occur;
equal doc_ids are ordered by a hash of the text, a null doc_id comes last.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import (
    Words,
    chunks,
    connected_components,
    gram_hashes,
    numbered,
    prepare,
    range_parts,
    runs,
    splitmix,
    tiled,
    written,
)

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 5
#: Registers of each family of a signature; bands use the first BANDS * ROWS,
#: all of them estimate a pair's similarity.
REGISTERS = 256
#: A pair whose estimate lies this many standard deviations below the
#: threshold leaves without an exact comparison (about 1 in 10,000 pairs at
#: the threshold).
DEVIATIONS = 3.7
#: Smallest block of a tile (registers of 1,024 documents are 1 to 2 MB; a row is
#: copied once for each block of its bucket).
BLOCK = 1024
#: Documents that one step of the kernel works on.
_DOCS = 2000
_ID = np.uint64(20)                 # a packed shingle: 44 bits of hash, 20 of weight
_COUNT = np.uint64((1 << 20) - 1)


def weighted_shingles(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Packed distinct shingles (sorted within a row) and the row offsets."""
    words = Words(data, offs)
    grams, count = gram_hashes(words.hashes(), words.first, shingle)
    # row and 44 bits of hash in one key: rows are fewer than 2^20
    row = np.repeat(np.arange(len(count), dtype=np.uint64), count)
    key = np.sort((row << np.uint64(44)) | (grams >> _ID))
    if not len(key):
        return key, np.zeros(len(count) + 1, dtype=np.int64)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    weight = np.minimum(np.diff(np.append(edge, len(key))), int(_COUNT)).astype(np.uint64)
    key = key[edge]
    at = np.searchsorted(key, np.arange(len(count) + 1, dtype=np.uint64) << np.uint64(44))
    return (key << _ID) | weight, at


def probminhash(packed: np.ndarray, at: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Registers (uint32, row by row) of packed shingle sets; rows without
    shingles get zeros."""
    rows = len(at) - 1
    size = np.diff(at)
    own = packed >> _ID
    weight = (packed & _COUNT).astype(np.float64)
    out = np.zeros((rows, registers), dtype=np.uint32)
    single = np.flatnonzero(size == 1)
    out[single] = (splitmix(own[at[single]]) >> np.uint64(32)).astype(np.uint32)[:, None]
    row = np.repeat(np.arange(rows), size)
    live = np.flatnonzero(size[row] > 1)
    first = np.full(rows * registers, np.inf)
    owner = out.reshape(-1)
    time = np.zeros(len(own))
    step = 0
    while len(live):
        x = splitmix(own[live] ^ np.uint64((step * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))
        gap = -np.log(((x >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52))
        time[live] += gap / weight[live]
        slot = row[live] * registers + ((splitmix(x) >> np.uint64(32)) % np.uint64(registers)).astype(np.int64)
        t = time[live]
        np.minimum.at(first, slot, t)
        won = t == first[slot]
        owner[slot[won]] = (splitmix(own[live[won]]) >> np.uint64(32)).astype(np.uint32)
        some = np.unique(row[live])
        last = np.zeros(rows)
        last[some] = first.reshape(rows, registers)[some].max(axis=1)
        live = live[t < last[row[live]]]
        step += 1
    return out


def both_families(packed: np.ndarray, at: np.ndarray, registers: int = REGISTERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted and plain registers, and which rows have uneven weights (the
    others' plain registers are their weighted ones)."""
    weighted = probminhash(packed, at, registers)
    size = np.diff(at)
    row = np.repeat(np.arange(len(size)), size)
    weight = packed & _COUNT
    uneven = np.zeros(len(size), dtype=bool)
    uneven[row[weight != weight[at[:-1][row]]]] = True
    plain = weighted.copy()
    if uneven.any():
        own = (packed[uneven[row]] & ~_COUNT) | np.uint64(1)
        plain[uneven] = probminhash(own, np.concatenate([[0], np.cumsum(size[uneven])]), registers)
    return weighted, plain, uneven


def similarities(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Exact probability Jaccard and plain Jaccard of two packed sets."""
    ia, ib = a >> _ID, b >> _ID
    both, pa_, pb_ = np.intersect1d(ia, ib, assume_unique=True, return_indices=True)
    union = len(ia) + len(ib) - len(both)
    if not len(both):
        return 0.0, 0.0
    wa, wb = (a & _COUNT).astype(np.float64), (b & _COUNT).astype(np.float64)
    only_a = wa.sum() - wa[pa_].sum()           # their ratio a/b is infinite
    x, y = wa[pa_], wb[pb_]
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # sum over all shingles j of max(x_j / x_i, y_j / y_i)
    only_b = wb.sum() - y.sum()
    edge = np.searchsorted(ratio, ratio, side="left")
    below_b = np.concatenate([[0.0], np.cumsum(y)])[edge] + only_b
    above_a = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[edge] + only_a
    return float((x / (above_a + ratio * below_b)).sum()), len(both) / union


def _steps(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, data, offs in chunks(batch.column(column)):
        for a in range(0, j - i, _DOCS):
            z = min(j - i, a + _DOCS)
            yield i + a, i + z, data[offs[a]:offs[z]], offs[a:z + 1] - offs[a]


def signatures(docs: DataFrame, shingle: int = SHINGLE, registers: int = REGISTERS) -> DataFrame:
    """``_n, registers`` (little-endian uint32; weighted and plain ones, or one
    family if they are the same) of every row of ``_n, _t`` that has a word."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in _steps(b, "_t"):
                packed, at = weighted_shingles(data, offs, shingle)
                weighted, plain, uneven = both_families(packed, at, registers)
                weighted, plain = weighted.astype("<u4"), plain.astype("<u4")
                full = np.flatnonzero(np.diff(at) > 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_n").slice(i, j - i).take(pa.array(full)),
                     pa.array([weighted[k].tobytes() + (plain[k].tobytes() if uneven[k] else b"") for k in full],
                              pa.binary())], ["_n", "registers"])

    return docs.select("_n", "_t").mapInArrow(sign, "_n long, registers binary")


def _registers(column: pa.Array, registers: int = REGISTERS) -> np.ndarray:
    """Registers by document, family and number."""
    raw = b"".join(r if len(r) == 8 * registers else r + r for r in column.to_pylist())
    return np.frombuffer(raw, dtype="<u4").reshape(len(column), 2, registers)


def _band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of the bands of both families, the weighted ones first."""
    regs = registers[:, :, :bands * rows].reshape(len(registers), 2 * bands, rows)
    key = np.broadcast_to(splitmix(np.arange(2 * bands, dtype=np.uint64)), regs.shape[:2]).copy()
    for k in range(rows):
        key = splitmix(key ^ regs[:, :, k].astype(np.uint64))
    return key.view(np.int64)


def _least(registers: int, threshold: float) -> float:
    return registers * threshold - DEVIATIONS * (registers * threshold * (1 - threshold)) ** 0.5


def _bands(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """``_n, bucket`` for each band; ``own``: the bucket may hold pairs that
    share no weighted band (a plain band of documents whose families are the
    same files them as their weighted band does)."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            regs = _registers(b.column("registers"))
            key = _band_keys(regs, bands, rows)
            own = np.ones(key.shape, dtype=bool)
            own[:, bands:] = (regs[:, 0] != regs[:, 1]).any(axis=1)[:, None]
            yield pa.RecordBatch.from_pydict({"_n": np.repeat(b.column("_n").to_numpy(), 2 * bands).astype(np.int64),
                                              "bucket": key.reshape(-1), "own": own.reshape(-1)})

    return signed.mapInArrow(split, "_n long, bucket long, own boolean")


def _likely(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose registers of one family do not rule out the threshold."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = _registers(b.column("ra")), _registers(b.column("rb"))
            ok = (x == y).sum(axis=2).max(axis=1) >= _least(x.shape[2], threshold)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    first = signed.select(F.col("_n").alias("a"), F.col("registers").alias("ra"))
    second = signed.select(F.col("_n").alias("b"), F.col("registers").alias("rb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "ra", "rb").mapInArrow(near, "a long, b long")


def _partners(t: pa.Table, lo: int, hi: int, regs: np.ndarray, group: np.ndarray, least: float, bands: int,
              rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of the tile ``t[lo:hi]`` with their likely partners, likeliest
    first. A pair is likely in one bucket only, by the first band in which it
    agrees; ``group`` (of the tile's rows) may grow while this goes on."""
    n, mine, i, j, bucket = (t[k].to_numpy() for k in ("_n", "mine", "i", "j", "bucket"))
    left = lo + np.flatnonzero(mine[lo:hi] == i[lo])
    right = lo + np.flatnonzero(mine[lo:hi] == j[lo])
    for x in left:
        y = right[(group[right - lo] != group[x - lo]) & (n[right] > n[x] if i[lo] == j[lo] else True)]
        same = regs[y] == regs[x]
        agree = same.sum(axis=2).max(axis=1)
        y, same, agree = y[agree >= least], same[agree >= least], agree[agree >= least]
        if len(y):
            agreed = same[:, :, :bands * rows].reshape(len(y), 2 * bands, rows).all(axis=2).argmax(axis=1)
            here = _band_keys(regs[x:x + 1], bands, rows)[0][agreed] == bucket[lo]
            if here.any():
                yield int(x), y[here][np.argsort(-agree[here], kind="stable")]


_TILE = ["bucket", "i", "j"]


def _in_tiles(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*_TILE, "mine", "_n", "root", *columns).repartitionByRange(range_parts(rows), *_TILE) \
        .sortWithinPartitions(*_TILE)


def _with_partner(placed: DataFrame, signed: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """Rows of tiles (``bucket, i, j, mine, _n, root``) that have a likely
    partner of another root in their tile; they alone are compared exactly."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in runs(batches, _TILE):
            regs, root = _registers(t["registers"].combine_chunks()), t["root"].to_numpy()
            least, some = _least(regs.shape[2], threshold), np.zeros(t.num_rows, dtype=bool)
            for lo, hi in zip(edges, edges[1:]):
                for x, y in _partners(t, lo, hi, regs, root[lo:hi], least, bands, rows):
                    some[x] = some[y] = True
            yield from t.select([*_TILE, "mine", "_n", "root"]).filter(pa.array(some)).to_batches()

    tiles = tiled(placed, "bucket", "_n", BLOCK).join(signed, "_n")
    return _in_tiles(tiles, ["registers"]).mapInArrow(look, "bucket long, i int, j int, mine int, _n long, root long")


def _joined_in_buckets(likely: DataFrame, signed: DataFrame, sets: DataFrame, threshold: float, bands: int,
                       rows: int) -> DataFrame:
    """Links between the rows of :func:`_with_partner`. A pair is judged
    exactly unless links of this tile join the two already, so a tile returns
    at most one link for each of its rows, however many pairs are likely."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in runs(batches, _TILE):
            regs, n, root = _registers(t["registers"].combine_chunks()), t["_n"].to_numpy(), t["root"].to_numpy()
            raw, least = t["s"].combine_chunks(), _least(regs.shape[2], threshold)
            found: list[tuple[int, int]] = []
            for lo, hi in zip(edges, edges[1:]):
                group = np.unique(root[lo:hi], return_inverse=True)[1]        # of each row; joined below
                for x, near in _partners(t, lo, hi, regs, group, least, bands, rows):
                    own = np.frombuffer(raw[x].as_py(), dtype="<u8")
                    for k in near:
                        if group[k - lo] != group[x - lo] and max(similarities(
                                own, np.frombuffer(raw[int(k)].as_py(), dtype="<u8"))) >= threshold:
                            group[group == group[k - lo]] = group[x - lo]
                            found.append((min(n[x], n[k]), max(n[x], n[k])))
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})

    return _in_tiles(likely.join(signed.join(sets, "_n"), "_n"), ["registers", "s"]).mapInArrow(compare, "a long, b long")


def _shingle_sets(docs: DataFrame, some: DataFrame, shingle: int, name: str) -> DataFrame:
    """``_n, s`` (packed shingles) of those documents ``_n, _t`` whose ``_n`` is in ``some``."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in _steps(b, "_t"):
                packed, at = weighted_shingles(data, offs, shingle)
                raw = packed.astype("<u8")
                yield pa.RecordBatch.from_arrays(
                    [b.column("_n").slice(i, j - i),
                     pa.array([raw[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary())], ["_n", "s"])

    return written(docs.join(some, "_n", "left_semi").select("_n", "_t").mapInArrow(shingles, "_n long, s binary"), name)


def _verified(likely: DataFrame, docs: DataFrame, shingle: int, threshold: float, name: str) -> DataFrame:
    """``a, b`` of those pairs that are similar enough, by their shingles."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [max(similarities(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"))) >= threshold
                  for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    likely = written(likely, f"{name}-likely")
    some = likely.select(F.col("a").alias("_n")).union(likely.select("b")).distinct()
    sets = _shingle_sets(docs, some, shingle, f"{name}-sets")
    return written(likely.join(sets.select(F.col("_n").alias("a"), F.col("s").alias("sa")), "a")
                   .join(sets.select(F.col("_n").alias("b"), F.col("s").alias("sb")), "b")
                   .select("a", "b", "sa", "sb").mapInArrow(exact, "a long, b long"), f"{name}-links")


def _groups(docs: DataFrame, shingle: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """``_n, _root`` of all documents ``_n, _t``."""
    texts = written(docs.filter(F.col("_t").rlike(r"[^\x20\x09-\x0D]"))
                    .select("_n", F.xxhash64("_t").alias("h"), F.xxhash64(F.lit(1), "_t").alias("k")), "minhash-texts")
    copies = texts.groupBy("h", "k").agg(F.min("_n").alias("rep"))
    copies = written(copies, "minhash-copies")
    signed = written(signatures(docs, shingle)
                     .join(copies.select(F.col("rep").alias("_n")), "_n", "left_semi"), "minhash-registers")
    filed = _bands(signed, bands, rows)
    buckets = written(filed.groupBy("bucket").agg(F.min("_n").alias("lead"), F.max("_n").alias("other"),
                                                   F.max("own").alias("own"))
                      .filter("lead < other and own").select("bucket", "lead"), "minhash-buckets")
    members = written(_bands(signed, bands, rows).drop("own").join(buckets, "bucket"), "minhash-members")
    pairs = written(members.filter("_n <> lead").select(F.col("lead").alias("a"), F.col("_n").alias("b")).distinct(),
                    "minhash-pairs")
    links = _verified(_likely(pairs, signed, threshold), docs, shingle, threshold, "minhash")
    roots = connected_components(links, "minhash")
    # documents of one bucket that are still in different groups
    placed = members.select("bucket", "_n").join(roots.withColumnRenamed("node", "_n"), "_n", "left") \
        .select("bucket", "_n", F.coalesce("root", "_n").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
        .filter("lo < hi").select("bucket")
    placed = written(placed.join(mixed, "bucket", "left_semi"), "minhash-mixed")
    likely = written(_with_partner(placed, signed, threshold, bands, rows), "minhash-likely-rows")
    sets = _shingle_sets(docs, likely.select("_n").distinct(), shingle, "minhash-likely-sets")
    more = written(_joined_in_buckets(likely, signed, sets, threshold, bands, rows), "minhash-more")
    if not more.isEmpty():
        roots = connected_components(links.union(more), "minhash-all")
    named = copies.join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("h", "k", F.coalesce("root", "rep").alias("_root"))
    linked = texts.join(named, ["h", "k"]).select("_n", "_root")
    return linked.union(docs.filter(~F.coalesce(F.col("_t").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
                        .select("_n", F.col("_n").alias("_root")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id, kept`` of every row: the smallest doc_id of the
    group, and whether this document is the one that stays."""
    prepare(docs.sparkSession)
    one, names = numbered(docs, "minhash", doc_id, text)
    groups = _groups(one, shingle, threshold, bands, rows)
    if names is None:
        return groups.select(F.col("_n").alias("doc_id"), F.col("_root").alias("class_id"),
                             (F.col("_n") == F.col("_root")).alias("kept"))
    groups = written(groups, "minhash-groups")
    lead = names.select(F.col("_n").alias("_root"), F.col("_id").alias("class_id"))
    return groups.join(names, "_n").join(lead, "_root") \
        .withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows")))) \
        .select(F.col("_id").alias("doc_id"), "class_id", (F.col("_n") == F.col("_root")).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: one document of each group; of
    rows that repeat its doc_id and text the first by all columns."""
    prepare(docs.sparkSession)
    one, names = numbered(docs, "minhash")
    groups = _groups(one, shingle, threshold, BANDS, ROWS)
    if names is None:
        gone = written(groups.filter("_n <> _root").select("_n"), "minhash-gone")
        return docs.alias("d").join(gone.alias("g"), F.col("d.doc_id").cast("long") == F.col("g._n"), "left_anti")
    stay = written(groups.filter("_n = _root").select("_n").join(names, "_n"), "minhash-stay")
    key, rank = "_lk_h", "_lk_r"
    while key in docs.columns or rank in docs.columns:
        key, rank = key + "_", rank + "_"
    named = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    single = named.alias("d").join(stay.alias("s"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("s._id"))
                                   & (F.col(f"d.{key}") == F.col("s._h")), "left_semi")
    # of rows that repeat doc_id and text the first one by all columns, so that reruns agree
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"ignoreNullFields": "false"})
    first = F.row_number().over(Window.partitionBy("doc_id", key).orderBy(whole))
    return single.withColumn(rank, first).filter(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
