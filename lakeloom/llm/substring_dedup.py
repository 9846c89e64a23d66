"""Substring dedup: drop words covered by a run of words that occurs earlier.

A window is ``window`` consecutive words of one document; it is a repeat when
its words also start at an earlier place (smaller doc_id, or the same document
further left). Every word covered by a repeat goes.

1. Each window is filed under its anchor, the word n-gram with the smallest
   hash in it (leftmost of equals). Equal windows have equal anchors, so only
   documents that share an anchor need to meet. The windows of one anchor
   occurrence form a fragment. Anchors that occur once in the corpus end here.
2. Equal fragments are settled together: all but the first place are repeats.
3. What is left are anchors with several different fragments (the rims of
   shared passages and edits). They are dealt to shards by anchor. Each shard
   builds a compressed FM-index of its fragments and streams them through
   backward search: matching statistics tell, for every word, how long a run
   that ends there also occurs earlier, and runs of ``window`` words or more
   are reported.
4. An anchor with more than ``HOT_FRAGMENTS`` different fragments would fill a
   shard alone. Its windows are dealt by their own hash instead; equal ones
   meet and all but the first are repeats.

Words are ``[^\\x20\\x09-\\x0D]+`` and are compared by 64-bit hashes (40 bits in
the index). Null text has no words. Rows that repeat doc_id and text are one
document, returned as often as they occur; equal doc_ids are ordered by a hash
of the text, a null doc_id comes last. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Words, chunks, numbered, prepare, range_hashes, written
from lakeloom.llm.fm_index import FmIndex

WINDOW = 20
GRAM = 6
HOT_FRAGMENTS = 256
#: Fragments per shard, on average.
SHARD_FRAGMENTS = 1000


class Anchors:
    """Anchor occurrences of the rows of one chunk: the anchor's hash, its
    row, first and last window start (words of the row), fragment hash."""

    def __init__(self, words: Words, window: int, gram: int):
        h, first = words.hashes(), words.first
        self.hashes = h
        n, size = len(h), np.diff(first)
        row_end = np.repeat(first[1:], size)
        at = np.arange(n)
        fits = at + gram <= row_end
        value = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
        value[fits] = range_hashes(h, at[fits], at[fits] + gram)
        place, reach, span = at.copy(), 1, window - gram + 1
        low = value.copy()
        while reach < span:                      # leftmost minimum of ``span`` grams
            step = min(reach, span - reach)
            right = low[step:] < low[:n - step]
            low[:n - step] = np.where(right, low[step:], low[:n - step])
            place[:n - step] = np.where(right, place[step:], place[:n - step])
            reach += step
        start = np.flatnonzero(at + window <= row_end)
        p = place[start]
        new = np.ones(len(start), dtype=bool)
        if len(start):
            row_of = np.repeat(np.arange(len(size)), size)
            r = row_of[start]
            new[1:] = (p[1:] != p[:-1]) | (r[1:] != r[:-1])
            edge = np.flatnonzero(new)
            last = np.append(edge[1:], len(start)) - 1
            self.row = r[edge]
            self.hash = value[p[edge]].view(np.int64)
            self.first = start[edge] - first[self.row]
            self.last = start[last] - first[self.row]
            self.fragment = range_hashes(h, start[edge], start[last] + window).view(np.int64)
        else:
            self.row = self.first = self.last = np.zeros(0, dtype=np.int64)
            self.hash = self.fragment = np.zeros(0, dtype=np.int64)


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``_n, start, stop``: word ranges covered by repeats (they may overlap).
    ``docs`` has ``_n`` (distinct, in document order) and ``_t``."""
    prepare(docs.sparkSession)
    depth = window
    if not 1 <= gram <= window:
        raise ValueError("an anchor must fit a window")

    def anchors_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offs in chunks(b.column("_t")):
                g, n = np.unique(Anchors(Words(data, offs), window, gram).hash, return_counts=True)
                yield pa.RecordBatch.from_pydict({"g": g, "n": n.astype(np.int64)})

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column("_n").to_numpy()
            for i, _, data, offs in chunks(b.column("_t")):
                a = Anchors(Words(data, offs), window, gram)
                yield pa.RecordBatch.from_pydict({
                    "g": a.hash, "f": a.fragment, "_n": names[i + a.row].astype(np.int64),
                    "a": a.first.astype(np.int32), "b": a.last.astype(np.int32)})

    again = written(docs.select("_t").mapInArrow(anchors_only, "g long, n long")
                    .groupBy("g").agg(F.sum("n").alias("n")).filter("n > 1").select("g"), "substr-anchors")
    found = written(docs.select("_n", "_t").mapInArrow(occurrences, "g long, f long, _n long, a int, b int")
                    .join(again, "g", "left_semi"), "substr-places")
    # equal fragments: the first place counts, the others are repeats
    fragments = written(found.groupBy("g", "f").agg(F.min(F.struct("_n", "a", "b")).alias("first"),
                                                    F.count("*").alias("n")), "substr-fragments")
    many = fragments.filter("n > 1").select("g", "f", "first")
    copies = found.alias("o").join(many.alias("m"), (F.col("o.g") == F.col("m.g")) & (F.col("o.f") == F.col("m.f"))) \
        .filter("o._n <> m.first._n or o.a <> m.first.a") \
        .select("o._n", F.col("o.a").alias("start"), (F.col("o.b") + window).alias("stop"))
    # anchors with several different fragments
    kinds = fragments.groupBy("g").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    open_ = written(fragments.join(kinds, "g").select(
        "first._n", F.struct("first.a", "first.b", "g", (F.col("kinds") > HOT_FRAGMENTS).alias("hot")).alias("p")),
        "substr-open")
    pieces = written(_cut_pieces(docs, open_, window), "substr-pieces")
    hot = pieces.filter("words is null")
    firsts = hot.groupBy("key").agg(F.min(F.struct("_n", "a")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    same = hot.alias("o").join(firsts.alias("m"), F.col("o.key") == F.col("m.key")) \
        .filter("o._n <> m.first._n or o.a <> m.first.a") \
        .select("o._n", F.col("o.a").alias("start"), (F.col("o.a") + window).alias("stop"))
    cold = pieces.filter("words is not null")
    shards = max(1, -(-cold.count() // SHARD_FRAGMENTS))

    def search(table: pa.Table) -> pa.Table:
        return _search(table, window, depth)

    ran = cold.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard") \
        .applyInArrow(search, "_n long, start int, stop int")
    return copies.union(same).union(ran)


def _cut_pieces(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """Words of fragments (40-bit hashes), or of hot ones the hash of each window."""
    per_doc = places.groupBy("_n").agg(F.collect_list("p").alias("p"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, lists = b.column("_n").to_numpy(), b.column("p")
            counts = np.asarray(lists.value_lengths())
            flat = lists.flatten()
            a, z = flat.field("a").to_numpy().astype(np.int64), flat.field("b").to_numpy().astype(np.int64)
            g, is_hot = flat.field("g").to_numpy(), flat.field("hot").to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(counts)), counts)
            for i, j, data, offs in chunks(b.column("_t")):
                w = Words(data, offs)
                h = w.hashes()
                mine = np.flatnonzero((of >= i) & (of < j))
                if not len(mine):
                    continue
                base = w.first[of[mine] - i]
                packed = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1)
                raw = packed.tobytes()
                c = np.flatnonzero(~is_hot[mine])
                lo, hi = 5 * (base[c] + a[mine[c]]), 5 * (base[c] + z[mine[c]] + window)
                yield pa.RecordBatch.from_arrays([
                    pa.array(g[mine[c]]), pa.array(names[of[mine[c]]].astype(np.int64)),
                    pa.array(a[mine[c]].astype(np.int32)),
                    pa.array([raw[x:y] for x, y in zip(lo, hi)], pa.binary())], ["key", "_n", "a", "words"])
                c = np.flatnonzero(is_hot[mine])
                each = z[mine[c]] - a[mine[c]] + 1
                q = np.repeat(c, each)
                s = a[mine[q]] + np.arange(len(q)) - np.repeat(np.cumsum(each) - each, each)
                keys = range_hashes(h, base[q] + s, base[q] + s + window) if len(q) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.view(np.int64)), pa.array(names[of[mine[q]]].astype(np.int64)),
                    pa.array(s.astype(np.int32)), pa.nulls(len(q), pa.binary())], ["key", "_n", "a", "words"])

    joined = docs.join(per_doc, "_n").select("_n", "_t", "p")
    return joined.mapInArrow(cut, "key long, _n long, a int, words binary")


def _search(table: pa.Table, window: int, depth: int) -> pa.Table:
    """Repeats among the fragments of one shard."""
    names = table.column("_n").to_numpy()
    first = table.column("a").to_numpy().astype(np.int64)
    pieces = []
    for raw in table.column("words").to_pylist():
        wide = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
        wide[:, :5] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
        pieces.append(wide.reshape(-1).view("<u8"))
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    # places as numbers: documents by rank, words within the largest position
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    width = int((first + size).max()) + 1
    order = [r * width + f + np.arange(n) for r, f, n in zip(rank, first, size)]
    index = FmIndex(pieces, order, depth)
    words, own = np.concatenate(pieces), np.concatenate(order)
    base = np.cumsum(size) - size
    each = size - window + 1
    row = np.repeat(np.arange(len(pieces)), each)
    start = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    ends = base[row] + start + window - 1
    length = index.matching_statistics(words, ends, window, own, np.full(len(ends), window))
    hit = np.flatnonzero(length >= window)
    begin = first[row[hit]] + start[hit]
    return pa.table({"_n": names[row[hit]].astype(np.int64), "start": begin.astype(np.int32),
                     "stop": (begin + window).astype(np.int32)})


def _merged(docs: DataFrame, doc_id: str, text: str, window: int, gram: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    own, names = numbered(docs, "substr", doc_id, text)
    runs = written(repeated_runs(own, window, gram), "substr-runs")
    per_doc = runs.groupBy("_n").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    return own, per_doc, names


def _gone(words: Words, lists: pa.Array) -> np.ndarray:
    """Which words of a chunk the runs of its rows cover."""
    counts = np.asarray(lists.value_lengths().fill_null(0)) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten()
    base = np.repeat(words.first[:-1], counts)
    delta = np.zeros(words.first[-1] + 1, dtype=np.int64)
    np.add.at(delta, base + flat.field("start").to_numpy(), 1)
    np.add.at(delta, base + flat.field("stop").to_numpy(), -1)
    return np.cumsum(delta[:-1]) > 0


def _joined(words: Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words, each followed by one space, and the byte offsets of rows."""
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    data = np.append(words.data, np.uint8(0x20))
    out = data[np.repeat(start - (ends - size), size) + np.arange(total)]
    out[ends - 1] = 0x20
    kept_before = np.concatenate([[0], np.cumsum(keep)])[words.first]
    return out.tobytes(), np.concatenate([[0], ends])[kept_before]


def removal_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (of the kept words joined
    by one space) of every row."""
    docs_n, per_doc, names = _merged(docs, doc_id, text, window, gram)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in chunks(b.column("_t")):
                w = Words(data, offs)
                gone = _gone(w, b.column("runs").slice(i, j - i))
                raw, at = _joined(w, ~gone)
                before = np.concatenate([[0], np.cumsum(gone)])[w.first]
                yield pa.RecordBatch.from_pydict({
                    "_n": b.column("_n").slice(i, j - i), "n_words": w.count.astype(np.int64),
                    "n_removed": np.diff(before).astype(np.int64),
                    "kept_sha256": [hashlib.sha256(raw[a:max(a, z - 1)]).hexdigest() for a, z in zip(at, at[1:])]})

    out = docs_n.join(per_doc, "_n", "left").select("_n", "_t", "runs").mapInArrow(
        digest, "_n long, n_words long, n_removed long, kept_sha256 string")
    if names is None:
        return out.withColumnRenamed("_n", "doc_id")
    return out.join(names, "_n").withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows")))) \
        .select(F.col("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows of ``docs`` with repeats cut out of ``text`` (a removed word goes
    with the white space after it) and ``n_chars`` counted anew; documents
    that lose all their words go, texts without repeats stay as they are."""
    _, per_doc, names = _merged(docs, "doc_id", "text", window, gram)
    cols = docs.columns
    here = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])
    at_id, at_text = f"c{cols.index('doc_id')}", f"c{cols.index('text')}"
    on: Column
    if names is None:
        on = F.col(f"d.{at_id}").cast("long") == F.col("r._n")
        runs = per_doc
    else:
        runs = per_doc.join(names, "_n")
        on = F.col(f"d.{at_id}").cast("long").eqNullSafe(F.col("r._id")) \
            & (F.xxhash64(F.coalesce(F.col(f"d.{at_text}"), F.lit(""))) == F.col("r._h"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            source = b.column(at_text)
            new: list[str | None] = []
            left = np.zeros(b.num_rows, dtype=bool)
            for i, j, data, offs in chunks(source):
                w = Words(data, offs)
                gone = _gone(w, b.column("runs").slice(i, j - i))
                covered = np.zeros(len(data) + 1, dtype=np.int8)
                stop = np.minimum(np.append(w.start[1:], len(data))[:len(w.start)],
                                  np.repeat(offs[1:], w.count))
                np.add.at(covered, w.start[gone], 1)
                np.add.at(covered, stop[gone], -1)
                keep = np.cumsum(covered[:-1], dtype=np.int64) == 0
                body = data[keep].tobytes()
                place = np.concatenate([[0], np.cumsum(keep)])[offs]
                before = np.concatenate([[0], np.cumsum(gone)])[w.first]
                left[i:j] = (np.diff(before) == 0) | (np.diff(before) < w.count)
                new.extend(body[a:z].decode("utf-8") for a, z in zip(place, place[1:]))
            fresh = pa.array(new, pa.string())
            if source.null_count:
                fresh = pa.array([None if v is None else t for v, t in zip(source.to_pylist(), new)], pa.string())
            out = {n: (fresh if n == at_text else b.column(n)) for n in b.schema.names if n != "runs"}
            yield pa.RecordBatch.from_pydict(out).filter(pa.array(left))

    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    joined = here.alias("d").join(runs.select("runs", *([] if names is None else ["_id", "_h"]),
                                              *(["_n"] if names is None else [])).alias("r"), on, "left") \
        .select("d.*", "r.runs")
    out = joined.mapInArrow(cut, fields)
    back = [F.col(f"c{i}").alias(c) if c != "n_chars"
            else F.coalesce(F.char_length(at_text).cast(docs.schema[c].dataType), F.col(f"c{i}")).alias(c)
            for i, c in enumerate(cols)]
    return out.select(*back)


SUBSTRING_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS run
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(words) - 18, 1))) AS i)),
f AS (SELECT run, min({'d': doc_id, 'i': i}) AS first, count(*) AS n FROM s GROUP BY run HAVING count(*) > 1),
r AS (SELECT s.doc_id, s.i FROM s JOIN f USING (run) WHERE s.doc_id <> f.first.d OR s.i <> f.first.i),
g AS (SELECT DISTINCT doc_id, i + o AS pos FROM r, LATERAL (SELECT unnest(range(0, 20)) AS o)),
x AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(words, lambda v, k: NOT list_contains(coalesce(gone, []), k)), ' ')) AS kept_sha256
FROM w LEFT JOIN x USING (doc_id)
"""
