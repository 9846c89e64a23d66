"""Best-fit packing by a configuration linear program.

Documents become pieces of at most ``limit`` tokens. The number of pieces of
each length (at most ``limit`` numbers) is all the driver sees. A
configuration says how many pieces of each length share one sequence; the
program "fewest sequences whose configurations hold every piece" is solved in
fractions by multiplicative weights: lengths lose weight as they are covered, a
knapsack prices the next configuration, and a lower bound from the program's
dual says how far the solution is from the best (:func:`configuration_lp`).
Its multiplicities are rounded to whole sequences (:func:`pack_plan`), so every
slot holds exactly one piece. Spark then numbers the pieces of each length and
reads their place off the plan.

Null text is an empty document (its end id only). Repeated rows, equal
doc_ids and null doc_ids are separate documents. An empty table gives no
pieces. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import prepare, range_buckets, regrouped, running_before, written
from lakeloom.llm.tokens import encoder

PIECE = ("doc_id long, piece int, start long, length long, ids_crc32 long")


def document_pieces(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0,
                    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``; only documents
    over ``limit`` are cut. ``with_ids`` adds the piece's ids."""
    prepare(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in regrouped(batches, "t"):
            ids, offs = encoder(tokenizer).encode(table["t"])
            n = np.diff(offs) + 1
            count = -(-n // limit)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * limit
            length = np.minimum(n[row] - start, limit)
            at = offs[row] + start
            end = np.array([end_id], dtype="<u4")
            raw = ids.astype("<u4", copy=False)
            last = start + length == n[row]
            own = [raw[a:a + size - tail] for a, size, tail in zip(at, length, last)]
            crc = [zlib.crc32(end, zlib.crc32(x)) if tail else zlib.crc32(x)
                   for x, tail in zip(own, last)]
            out = {"doc_id": table["d"].combine_chunks().take(pa.array(row)),
                   "piece": piece.astype(np.int32), "start": start.astype(np.int64),
                   "length": length.astype(np.int64), "ids_crc32": np.array(crc, dtype=np.int64)}
            if with_ids:
                out["ids"] = pa.array([np.concatenate([x, end]) if tail else x
                                       for x, tail in zip(own, last)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")) \
        .mapInArrow(cut, PIECE + (", ids array<int>" if with_ids else ""))


# --- the plan (driver; its size depends on the limit, not on the corpus) -----

def _knapsack(size: np.ndarray, value: np.ndarray, limit: int) -> list[int]:
    """Items of the largest total value within ``limit`` (each at most once)."""
    best = np.zeros(limit + 1)
    took = np.zeros((len(size), limit + 1), dtype=bool)
    for k, (s, v) in enumerate(zip(size.tolist(), value.tolist())):
        with_it = best[:-s] + v
        took[k, s:] = with_it > best[s:]
        best[s:] = np.maximum(best[s:], with_it)
    out, room = [], limit
    for k in range(len(size) - 1, -1, -1):
        if took[k, room]:
            out.append(k)
            room -= int(size[k])
    return out


def _bound(size: np.ndarray, demand: np.ndarray, price: np.ndarray, limit: int) -> float:
    """The program's value is at least this: prices scaled so that no
    configuration is worth more than 1 are a solution of its dual."""
    worth = np.zeros(limit + 1)
    worth[size] = price
    best = np.zeros(limit + 1)
    for room in range(1, limit + 1):
        best[room] = max(best[room - 1], float((worth[1:room + 1] + best[:room][::-1]).max()))
    return float((demand * price).sum() / best[limit])


def _configuration(size: np.ndarray, demand: np.ndarray, left: np.ndarray, price: np.ndarray, limit: int,
                   draw: np.random.Generator, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The longest length that is not covered yet and the most valuable rest
    over ``columns`` lengths drawn by the tokens they still hold."""
    open_ = np.flatnonzero(left > 0)
    lead = int(open_[-1])
    room = limit - int(size[lead])
    free = demand.copy()
    free[lead] -= 1
    pool = open_[(size[open_] <= room) & (free[open_] > 0)]
    if len(pool) > columns:
        key = np.log(draw.random(len(pool))) / (left[pool] * size[pool])
        items, copies = pool[np.argpartition(-key, columns)[:columns]], np.ones(columns, dtype=np.int64)
    else:                                   # few lengths: several copies of each
        items, copies = [], []
        for j in pool.tolist():
            most, n = min(int(free[j]), room // int(size[j])), 1
            while most > 0:
                items.append(j)
                copies.append(min(n, most))
                most, n = most - min(n, most), 2 * n
        items, copies = np.array(items, dtype=np.int64), np.array(copies, dtype=np.int64)
    config = {lead: 1}
    if len(items):
        for k in _knapsack(size[items] * copies, price[items] * copies, room):
            j = int(items[k])
            config[j] = config.get(j, 0) + int(copies[k])
    return np.array(list(config)), np.array(list(config.values()))


def _start_price(size: np.ndarray, limit: int, k: int) -> np.ndarray:
    """Prices under which no configuration is worth more than 1: a length's
    share of the limit (k = 0), or how many ``k + 1``-ths of the limit it fills,
    by ``k`` (a length of just that many: its share)."""
    share = size / limit
    return np.where(size * (k + 1) % limit == 0, share, size * (k + 1) // limit / k) if k else share


#: Start prices, steps and rates of the multiplicative weights, tried until the
#: gap is small. The first rate (None) moves a price by less than one token.
_LADDER = ((0, 1.0, None), (0, 0.5, None), (1, 1.0, None), (2, 1.0, None), (3, 1.0, None), (4, 1.0, None),
           (0, 0.5, 0.25), (0, 0.25, 1.0), (0, 0.125, 4.0))
_GAP = 1e-5
#: Of programs of so few sequences one configuration is rounded at a time.
_TAIL = 32


def configuration_lp(size: np.ndarray, demand: np.ndarray, limit: int, draw: np.random.Generator,
                     columns: int = 128) -> tuple[list[tuple[float, np.ndarray, np.ndarray]], float, float]:
    """``(configurations, value, bound)`` of the program "fewest sequences, in
    fractions, whose configurations hold every piece": multiplicity, lengths
    (indices of ``size``, ascending) and their pieces.

    Multiplicative weights: a length's price is a start price times a weight
    that falls by ``exp(-rate * share)`` with the share of its pieces that a
    step covers. A knapsack prices the configuration that is taken next, as
    often as its scarcest length allows (at most ``step`` of that length's
    pieces). The prices on the way give lower bounds of the value by an exact
    knapsack over all lengths. Other start prices, smaller steps and higher
    rates follow until value and bound differ by less than ``_GAP`` or a
    sequence.
    """
    best: list = []
    value, bound = np.inf, 0.0
    for k, step, rate in _LADDER:
        rate = 0.9 / limit if rate is None else rate
        start = _start_price(size, limit, k)
        price = start + (1e-3 * size / limit if k else 0)       # of equal prices the fuller sequence
        if start.any():
            bound = max(bound, _bound(size, demand, start, limit))
        left, weight = demand.astype(np.float64), np.ones(len(size))
        found, used, mark = [], 0.0, 0.875
        tokens = float((left * size).sum())
        while left.any():
            if (left * size).sum() <= mark * tokens:            # eight times a pass
                bound = max(bound, _bound(size, demand, price * weight, limit))
                mark -= 0.125
            js, a = _configuration(size, demand, left, price * weight, limit, draw, columns)
            times = float(min((left[js] / a).min(), step * (demand[js] / a).min()))
            found.append((times, js, a))
            used += times
            left[js] -= times * a
            left[js[left[js] < 1e-9 * demand[js]]] = 0.0
            weight[js] *= np.exp(-rate * times * a / demand[js])
        if used < value:
            best, value = found, used
        if value <= max(bound * (1 + _GAP), np.ceil(bound)):
            break
    return best, value, bound


def pack_plan(histogram: dict[int, int], limit: int, columns: int = 128) -> list[tuple[int, dict[int, int]]]:
    """``(sequences, {length: pieces})``: every piece of the histogram in
    exactly one slot, no configuration over ``limit``.

    The configuration program is solved in fractions (:func:`configuration_lp`)
    and rounded: the whole part of each multiplicity is taken, and one more with
    the probability of its fraction where the pieces are there. What is left is
    a smaller program, solved and rounded the same way until nothing is left; of
    the last ``_TAIL`` sequences the longest length's configuration alone is
    rounded (up, where it is a fraction) before the next one is solved.
    """
    left_of = {int(k): int(v) for k, v in histogram.items() if v}
    if left_of and not 1 <= min(left_of) <= max(left_of) <= limit:
        raise ValueError("piece lengths must lie between 1 and the limit")
    plan: list[tuple[int, dict[int, int]]] = []
    if limit in left_of:
        plan.append((left_of.pop(limit), {limit: 1}))
    size = np.array(sorted(left_of), dtype=np.int64)
    left = np.array([left_of[int(x)] for x in size], dtype=np.int64)
    draw = np.random.default_rng(limit)
    while len(size):
        configs, value, _ = configuration_lp(size, left, limit, draw, columns)
        wanted, more = [int(x + 1e-6) for x, _, _ in configs], []
        if value > _TAIL:
            more = [k for k in draw.permutation(len(configs)).tolist() if draw.random() < configs[k][0] - wanted[k]]
        if not sum(wanted) + len(more) or value <= _TAIL:
            wanted = [max(wanted[0], 1)]            # the longest length's
        for k, times in [*enumerate(wanted), *((k, 1) for k in more)]:
            _, js, a = configs[k]
            times = min(times, int((left[js] // a).min()))
            if times:
                plan.append((times, {int(size[j]): int(n) for j, n in zip(js, a)}))
                left[js] -= times * a
        size, left = size[left > 0], left[left > 0]
    return plan


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, length,
    ids_crc32 and any other columns)."""
    held = range_buckets(written(pieces, "cut"), [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "pieces")
    histogram = {r["length"]: r["count"] for r in held.groupBy("length").count().collect()}
    plan = pack_plan(histogram, limit)
    slots: dict[int, list[tuple[int, int, int, int]]] = {}   # length: first rank, sequences, base, offset
    used: dict[int, int] = {}
    base = 0
    for times, config in plan:
        at = 0
        for size, a in sorted(config.items(), reverse=True):
            rank = used.get(size, 0)
            slots.setdefault(size, []).append((rank, times, base, at))
            used[size] = rank + times * a
            at += size * a
        base += times
    table = {k: np.array(v, dtype=np.int64) for k, v in slots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            seq, at = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for k in np.unique(size):
                mine = np.flatnonzero(size == k)
                t = table[int(k)]
                row = t[np.searchsorted(t[:, 0], rank[mine], side="right") - 1]
                idx = rank[mine] - row[:, 0]
                seq[mine] = row[:, 2] + idx % row[:, 1]
                at[mine] = row[:, 3] + idx // row[:, 1] * k
            names = [n for n in b.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(seq), pa.array(at)],
                                             [*names, "sequence_id", "offset"])

    ranked = running_before(held.withColumn("_one", F.lit(1).cast("long")), ["length"],
                            [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "_one", "_rank") \
        .drop("_one", "_bucket")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return pack(document_pieces(docs, tokenizer, limit, end_id), limit)
