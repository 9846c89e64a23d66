"""Token-id files, compressed by a grammar, with random access.

The ids of all documents, each closed by an end id, are written in ascending
doc_id order. A shard is one range of doc_ids; it is stored as blocks of about
``block_ids`` ids. In each block frequent adjacent pairs are replaced by
nonterminals again and again (Re-Pair); no pair crosses two documents. A block
holds its rules, the expansion length of every nonterminal, the symbols left
and each document's place among them, so one document or a range inside it can
be decoded without expanding the rest.

File format: Parquet rows ``shard, block, doc_ids, ends, symbols, rules,
n_ids`` (little-endian binaries; see :func:`compress`), with the least and
greatest doc_id of the block.

Null text is empty (its end id only). Null doc_ids come last. Equal doc_ids
follow each other by a hash of their text; repeated rows are written as often
as they occur. An empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import prepare, range_parts, regrouped, running_before
from lakeloom.llm.tokens import encoder

BLOCK_IDS = 1 << 20
#: A pair must occur this often in a block to become a rule.
MIN_COUNT = 16
MAX_ROUNDS = 4
#: Nonterminals that 16-bit symbols must leave room for; a larger vocabulary
#: gets 32-bit symbols and up to ``WIDE_RULES`` nonterminals a block.
NARROW_RULES = 1 << 13
WIDE_RULES = 1 << 17

SCHEMA = ("shard int, block int, doc_ids array<long>, ends binary, symbols binary, "
          "rules binary, n_ids long, n_docs long, first_id long, last_id long")


@dataclass
class Grammar:
    """Rules of one block: symbol ``base + i`` stands for ``rules[i]``."""

    base: int
    rules: np.ndarray        # (n, 2) uint32
    size: np.ndarray         # expansion length of every nonterminal, int64

    @classmethod
    def of(cls, base: int, rules: np.ndarray) -> Grammar:
        g = cls(base, rules, np.zeros(len(rules), dtype=np.int64))
        g.size = g.lengths_all()
        return g

    def lengths_all(self) -> np.ndarray:
        size = np.zeros(len(self.rules), dtype=np.int64)
        if not len(self.rules):
            return size
        inner = np.where(self.rules >= self.base, self.rules.astype(np.int64) - self.base, -1)
        # a rule only uses earlier ones; repeat until every length is known
        while (todo := np.flatnonzero(size == 0)).size:
            part = np.where(inner[todo] < 0, 1, size[np.maximum(inner[todo], 0)])
            done = (part > 0).all(axis=1)
            size[todo[done]] = part[done].sum(axis=1)
        return size

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol stands for."""
        out = np.ones(len(symbols), dtype=np.int64)
        inner = symbols >= self.base
        out[inner] = self.size[symbols[inner] - self.base]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a run of symbols, level by level."""
        seq = symbols.astype(np.uint32)
        while (inner := seq >= self.base).any():
            width = 1 + inner
            at = np.cumsum(width) - width
            out = np.empty(int(width.sum()), dtype=np.uint32)
            out[at[~inner]] = seq[~inner]
            pair = self.rules[seq[inner] - self.base]
            out[at[inner]] = pair[:, 0]
            out[at[inner] + 1] = pair[:, 1]
            seq = out
        return seq

    def slice(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids ``start..stop`` of the run: expansion lengths tell which
        symbols to expand."""
        ends = np.cumsum(self.lengths(symbols))
        a = int(np.searchsorted(ends, start, side="right"))
        b = int(np.searchsorted(ends, stop, side="left")) + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - before:stop - before]


def _slots(pairs: np.ndarray) -> np.ndarray:
    if pairs.dtype == np.uint32:
        return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return (pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def repair(ids: np.ndarray, doc_end: np.ndarray, base: int, min_count: int = MIN_COUNT,
           max_rounds: int = MAX_ROUNDS, max_symbol: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(symbols, ends, rules)``: pairs that occur at least ``min_count``
    times are replaced, most frequent first, round by round.

    ``doc_end`` holds the end of each document among the ids, ``ends`` among
    the symbols. Nonterminals stay below ``max_symbol`` so that symbols fit 16
    bits where the vocabulary allows it.
    """
    seq, ends = ids.astype(np.uint32), doc_end.astype(np.int64)
    rules = np.zeros((0, 2), dtype=np.uint32)
    per_round = max(1, (max_symbol - base) // max_rounds)
    for _ in range(max_rounds):
        room = min(per_round, max_symbol - base - len(rules))
        if len(seq) < 2 * min_count or room <= 0:
            break
        wide = max_symbol > 1 << 16              # else a pair fits 32 bits
        kind, half = (np.uint64, 32) if wide else (np.uint32, 16)
        low = kind((1 << half) - 1)
        key = (seq[:-1].astype(kind) << kind(half)) | seq[1:].astype(kind)
        free = np.ones(len(key), dtype=bool)
        inside = ends[(ends > 0) & (ends < len(seq))]
        free[inside - 1] = False
        ordered = np.sort(key[free])
        if not len(ordered):
            break
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        count = np.diff(np.append(edge, len(ordered)))
        many = np.flatnonzero(count >= min_count)
        if not len(many):
            break
        many = many[np.argsort(-count[many], kind="stable")[:room]]
        pairs = np.sort(ordered[edge[many]])
        # symbols that start or end a chosen pair rule out most positions
        hit = np.zeros(int(seq.max()) + 1, dtype=np.uint8)
        hit[(pairs >> kind(half)).astype(np.int64)] |= 1
        hit[(pairs & low).astype(np.int64)] |= 2
        side = hit[seq]
        maybe = np.flatnonzero(((side[:-1] & 1) & (side[1:] >> 1)).view(bool) & free)
        # place of each pair in a small hash table (of two pairs in one slot
        # only the later becomes a rule this round)
        slot = np.zeros(1 << 20, dtype=np.int32)
        slot[_slots(pairs)] = np.arange(len(pairs), dtype=np.int32)
        own = key[maybe]
        at = slot[_slots(own)]
        found = pairs[at] == own
        pos, which = maybe[found], at[found]
        # runs of overlapping pairs: take every other one from the run's start
        start = np.concatenate([[True], pos[1:] != pos[:-1] + 1])
        rank = np.arange(len(pos)) - np.maximum.accumulate(np.where(start, np.arange(len(pos)), 0))
        take = rank % 2 == 0
        pos, which = pos[take], which[take]
        used, which = np.unique(which, return_inverse=True)
        seq[pos] = (base + len(rules) + which).astype(np.uint32)
        gone = pos + 1
        rules = np.concatenate([rules, np.stack([pairs[used] >> kind(half),
                                                 pairs[used] & low], 1).astype(np.uint32)])
        stay = np.ones(len(seq), dtype=bool)
        stay[gone] = False
        seq = seq[stay]
        ends = ends - np.searchsorted(gone, ends, side="left")
        if len(gone) < len(seq) // 100:
            break
    return seq, ends, rules


def compress(ids: np.ndarray, doc_end: np.ndarray, base: int) -> dict:
    """One block: ``symbols`` (uint16 where every symbol fits, else uint32),
    ``ends`` (int64: end of each document among the symbols), ``rules``
    (uint32: left, right and expansion length of each nonterminal, after
    the first nonterminal's number and the width of a symbol)."""
    narrow = base + NARROW_RULES <= 1 << 16
    seq, ends, rules = repair(ids, doc_end, base, max_symbol=1 << 16 if narrow else base + WIDE_RULES)
    size = Grammar.of(base, rules).size
    narrow = base + len(rules) <= 1 << 16      # small blocks of a large vocabulary may fit as well
    head = np.array([[base, 2 if narrow else 4, len(rules)]], dtype="<u4")
    table = np.concatenate([head, np.column_stack([rules, size]).astype("<u4").reshape(-1, 3)])
    return {"ends": ends.astype("<i8").tobytes(), "rules": table.tobytes(),
            "symbols": seq.astype("<u2" if narrow else "<u4").tobytes()}


def opened(row: dict) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """Grammar, symbols and document ends of a stored block."""
    table = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 3)
    grammar = Grammar(int(table[0, 0]), table[1:, :2], table[1:, 2].astype(np.int64))
    symbols = np.frombuffer(row["symbols"], dtype="<u2" if table[0, 1] == 2 else "<u4").astype(np.uint32)
    return grammar, symbols, np.frombuffer(row["ends"], dtype="<i8")


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2,
                 block_ids: int = BLOCK_IDS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the files to ``path``."""
    spark = docs.sparkSession
    prepare(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, block = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        base = max(enc.vocab_size, end_id + 1)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate([h[1] for h in held])
            ends = np.cumsum(np.concatenate([h[2] for h in held]))
            names = pa.concat_arrays([h[0] for h in held])
            return pa.RecordBatch.from_pylist([
                {"shard": shard, "block": block, "doc_ids": names.to_pylist(), **compress(ids, ends, base),
                 "n_ids": len(ids), "n_docs": len(names), "first_id": pc.min(names).as_py(),
                 "last_id": pc.max(names).as_py()}], schema=schema)

        for table in regrouped(batches, "t"):
            ids, offs = enc.encode(table["t"])
            n = np.diff(offs)
            out = np.full(len(ids) + len(n), end_id, dtype=np.uint32)
            out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
            held.append((table["d"].combine_chunks().cast(pa.int64()), out, n + 1))
            size += len(out)
            if size >= block_ids:
                yield row()
                block, held, size = block + 1, [], 0
        if held:
            yield row()

    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                        ("ends", pa.binary()), ("symbols", pa.binary()), ("rules", pa.binary()),
                        ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("first_id", pa.int64()),
                        ("last_id", pa.int64())])
    src = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    order = [F.col("d").asc_nulls_last(), F.xxhash64("t")]
    src.repartitionByRange(range_parts(src), *order).sortWithinPartitions(*order) \
        .mapInArrow(encode, SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode the files: one row per document with ``start`` (ids before it),
    ``n_tokens``, ``ids_crc32`` (unsigned, of its little-endian 32-bit ids)
    and, on request, ``ids``."""
    prepare(spark)
    files = spark.read.schema(SCHEMA).parquet(path)
    starts = running_before(files.select("shard", "block", "n_ids", F.col("shard").alias("_bucket")), [],
                            [F.col("block")], "n_ids", "_start").select("shard", "block", "_start")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                grammar, symbols, ends = opened(row)
                ids = grammar.expand(symbols).astype("<u4", copy=False)
                own = np.concatenate([[0], np.cumsum(grammar.lengths(symbols))])[
                    np.concatenate([[0], ends])]
                n = len(ends)
                out = {"shard": np.full(n, row["shard"], np.int32), "block": np.full(n, row["block"], np.int32),
                       "doc_id": pa.array(row["doc_ids"], pa.int64()), "_inner": own[:-1],
                       "n_tokens": np.diff(own),
                       "ids_crc32": np.array([zlib.crc32(ids[a:z]) for a, z in zip(own, own[1:])], np.int64)}
                if with_ids:
                    out["ids"] = pa.array([ids[a:z].astype(np.int64) for a, z in zip(own, own[1:])],
                                          pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    decoded = files.select("shard", "block", "doc_ids", "ends", "symbols", "rules").mapInArrow(
        decode, "shard int, block int, doc_id long, _inner long, n_tokens long, ids_crc32 long"
        + (", ids array<long>" if with_ids else ""))
    return decoded.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("_start") + F.col("_inner")).alias("start"), "n_tokens", "ids_crc32",
        "shard", "block", *(["ids"] if with_ids else []))


def blocks_of(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The blocks that hold ``doc_id``. Blocks follow the order of doc_ids, so
    the bounds, which reach the scan, leave one or a few of them to be read."""
    wanted = F.lit(doc_id).cast("long")
    return spark.read.schema(SCHEMA).parquet(path) \
        .filter((F.col("first_id") <= wanted) & (F.col("last_id") >= wanted) & F.array_contains("doc_ids", wanted))


def read_document(spark: SparkSession, path: str, doc_id: int, start: int = 0,
                  stop: int | None = None) -> list[list[int]]:
    """Ids ``start..stop`` of every document stored under ``doc_id``; only
    blocks that name it are opened, and only the symbols of that range
    expanded."""
    rows = blocks_of(spark, path, doc_id).collect()
    out = []
    for row in sorted(rows, key=lambda r: (r["shard"], r["block"])):
        grammar, symbols, ends = opened(row.asDict())
        for i, name in enumerate(row["doc_ids"]):
            if name == doc_id:
                own = symbols[(ends[i - 1] if i else 0):ends[i]]
                total = int(grammar.lengths(own).sum())
                a, z, _ = slice(start, stop).indices(total)
                out.append(grammar.slice(own, a, z).tolist() if a < z else [])
    return out
