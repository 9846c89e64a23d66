"""Near-duplicate vectors by sorted projection passes.

Vectors of one label (and one dimension) are compared by cosine in double
precision; pairs at or above ``threshold`` are linked. In a pass they are
ordered lexicographically by the concatenated signs of random projections,
drawn anew for the pass, and every vector is compared with the next ``WINDOW``
ones. How many leading signs a partner must share to be within the window is
measured for each vector in each pass, which gives the chance that the pass
found a partner at the threshold. A vector leaves once its passes together miss
such a partner with a probability of at most ``MISS``. Vectors that share a
direction are hardly split by signs; what ``SETTLE`` passes have not settled of
a label is compared whole, in tiles, as soon as that costs no more than the
passes made. The links are united, and connected components follow.

Passes carry vectors in single precision. A cosine further from the threshold
than its rounding can be is decided there; the others are computed again in
double precision.

A window bounds candidates, not results: inside each component all pairs are
then compared exactly, in tiles of two blocks per task, which gives every
vector its number of links whatever the size of its cluster. Tiles return
counts, never pairs.

Equal vectors of a label are folded first and counted. A vector that is null,
zero, or has a null or non-finite component, or whose label is null, is linked
with nothing. Rows with equal or null vec_ids are vectors of their own; a null
vec_id is never a component's name unless all its vec_ids are null. Empty
tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import (
    connected_components,
    prepare,
    range_buckets,
    range_parts,
    running_before,
    runs,
    tiled,
    written,
)

THRESHOLD = 0.93
WINDOW = 256
MISS = 1e-4
BITS = 62
#: Passes of the first job and of each later one.
FIRST_PASSES, MORE_PASSES = 2, 6
#: Passes that every vector gets unless fewer settle it.
SETTLE = 20
#: Rows of one task of a pass; the window's width at its edges settles nothing.
TASK_ROWS = 32_768
#: Smallest block of a tile; blocks grow with the root of the component.
BLOCK = 32
#: Block of a tile where the rest of a label is compared whole: one copy of a
#: vector in a tile then costs about as much as its copy in a pass.
WHOLE = 4096
#: Rounding of two double dot products of unit vectors.
_EPS = 1e-12


def _projection(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([dim, number, 20_011]).standard_normal((dim, BITS))


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bits two codes share."""
    x = a ^ b
    high, low = x >> 31, x & 0x7FFFFFFF
    return BITS - np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 31, np.frexp(low.astype(np.float64))[1])


def _gains(group: np.ndarray, code: np.ndarray, threshold: float, window: int) -> np.ndarray:
    """``-log`` of the chance that a pass (one task's rows, in order, with the
    numbers of their groups) did not bring a vector and a partner at the
    threshold within ``window`` places. A partner that shares more leading
    bits than the vector ``window`` places on is nearer than that one. What
    lies beyond the task's rows is not known, so its edges gain nothing."""
    n = len(code)
    depth = np.zeros(n)                             # bits to share, 0: all the group is in the window
    if n > window:
        same = group[window:] == group[:-window]
        need = np.where(same, _shared(code[window:], code[:-window]) + 1, 0)
        depth[:-window] = need
        depth[window:] = np.maximum(depth[window:], need)
    first, last = group == group[0], group == group[-1]
    place = np.arange(n)
    depth[(first & (place < window)) | (last & (place >= n - window))] = BITS + 1
    bit = 1 - math.acos(threshold) / math.pi
    chance = np.where(depth > BITS, 0.0, np.minimum(bit ** depth, 1 - 1e-9))
    return -np.log1p(-chance)


def _units(vectors: DataFrame) -> DataFrame:
    """Distinct comparable vectors: ``c`` (in the order of their smallest
    vec_id), ``label, dim, unit`` (doubles), ``rows``, and their key."""
    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, dims, ok = [], [], []
            for v in b.column("v").to_pylist():
                x = np.array([np.nan if q is None else q for q in v], dtype=np.float64)
                top = np.abs(x).max() if len(x) else 0.0
                good = bool(len(x)) and bool(np.isfinite(x).all()) and top > 0
                if good:
                    x = x / top                  # squares neither overflow nor vanish
                    x /= np.linalg.norm(x)
                ok.append(good)
                dims.append(len(x))
                raw.append(x.astype("<f8").tobytes() if good else b"")
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in ("label", "h", "k", "id", "rows")), pa.array(dims, pa.int32()),
                 pa.array(raw, pa.binary())], ["label", "h", "k", "id", "rows", "dim", "unit"]).filter(pa.array(ok, pa.bool_()))

    seen = vectors.filter("label is not null and v is not null").groupBy("label", "h", "k").agg(
        F.min("id").alias("id"), F.count("*").alias("rows"), F.min("v").alias("v"))
    held = written(seen.mapInArrow(unit, "label string, h long, k long, id long, rows long, dim int, unit binary"),
                   "vector-units")
    order = [F.col("id").asc_nulls_last(), F.col("label"), F.col("h"), F.col("k")]
    ranged = range_buckets(held, order, "vector-order").withColumn("_one", F.lit(1).cast("long"))
    return written(running_before(ranged, [], order, "_one", "c").drop("_one", "_bucket"), "vector-classes")


def _union(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning set of the links of one task."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    out = []
    for a, b in pairs:
        x, y = top(a), top(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _joined(near: np.ndarray, part: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
    """Links of a block (``near[left, right]``) that join parts; ``part`` is updated."""
    a, b = [], []
    for r in np.flatnonzero(near.any(axis=1)):
        to = right[near[r]]
        to = to[part[to] != part[left[r]]]
        if len(to):
            parts, at = np.unique(part[to], return_index=True)
            part[np.isin(part, parts)] = part[left[r]]
            a += [int(left[r])] * len(at)
            b += to[at].tolist()
    return a, b


def _margin(dim: int) -> float:
    """How far a single-precision cosine of unit vectors can be off."""
    return 1.1 * (dim + 4) * 2.0 ** -24


def pass_links(classes: DataFrame, numbers: list[int], threshold: float = THRESHOLD,
               window: int = WINDOW, parts: int | None = None) -> DataFrame:
    """``a, b`` linked within the windows of the given passes (as many as
    keep each block's links connected), ``sure`` or to be computed again, and
    without ``b`` what each vector ``a`` gained in them."""
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, raw = b.column("dim").to_numpy(), b.column("unit").to_pylist()
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                x = np.frombuffer(b"".join(raw[i] for i in mine), dtype="<f8").reshape(len(mine), d)
                own = b.take(pa.array(mine))
                half = pa.array([r.tobytes() for r in x.astype("<f4")], pa.binary())
                for p in numbers:
                    sign = (x @ _projection(int(d), p) >= 0).astype(np.int64)
                    code = sign @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), p, np.int32)), own.column("label"), own.column("dim"),
                         pa.array(code), own.column("c"), half],
                        ["pass", "label", "dim", "code", "c", "unit"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        close: set[tuple[int, int]] = set()
        tail: pa.Table | None = None
        last, number = None, 0
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for b in batches:
            t = pa.Table.from_batches([b])
            if tail is not None:
                t = pa.concat_tables([tail, t]).combine_chunks()
            old = tail.num_rows if tail is not None else 0
            # runs of one pass, label and dimension
            keys = list(zip(t["pass"].to_pylist(), t["label"].to_pylist(), t["dim"].to_pylist()))
            c, raw = t["c"].to_numpy(), t["unit"].to_pylist()
            edge = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            group = np.zeros(len(keys), dtype=np.int64)
            group[edge[1:-1]] = 1
            group = np.cumsum(group[old:]) + number + (not old and last is not None and keys[0] != last)
            if len(group):
                seen.append((group, t["code"].to_numpy()[old:], c[old:]))
                last, number = keys[-1], int(group[-1])
            for i, j in zip(edge, edge[1:]):
                x = np.frombuffer(b"".join(raw[i:j]), dtype="<f4").reshape(j - i, -1)
                own, margin, part = c[i:j], _margin(x.shape[1]), np.arange(j - i)
                for s in range(0, j - i, window):
                    left, right = np.arange(s, min(j - i, s + window)), np.arange(s, min(j - i, s + 2 * window))
                    cos = x[left] @ x[right].T
                    gap = right[None, :] - left[:, None]
                    cos[(gap < 1) | (gap > window)] = -2
                    held = max(0, old - i - s)               # pairs inside the tail are done
                    cos[:held, :held] = -2
                    r, k = np.nonzero(np.abs(cos - threshold) <= margin)
                    close.update(zip(own[left[r]].tolist(), own[right[k]].tolist()))
                    for p, q in zip(*_joined(cos > threshold + margin, part, left, right)):
                        found.append((int(own[p]), int(own[q])))
            tail = t.slice(max(0, t.num_rows - window))
            found = _union(found)
        if not seen:
            return
        links = [(min(p), max(p), True) for p in found] + [(min(p), max(p), False) for p in close]
        yield pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in links], pa.int64()),
                                          "b": pa.array([x[1] for x in links], pa.int64()),
                                          "sure": pa.array([x[2] for x in links], pa.bool_()),
                                          "gain": pa.nulls(len(links), pa.float64())})
        group, code, c = (np.concatenate(x) for x in zip(*seen))
        gain = _gains(group, code, threshold, window)
        for i in range(0, len(c), 65_536):
            own = slice(i, i + 65_536)
            yield pa.RecordBatch.from_pydict({"a": c[own], "b": pa.nulls(len(c[own]), pa.int64()),
                                              "sure": pa.nulls(len(c[own]), pa.bool_()), "gain": gain[own]})

    order = ["pass", "label", "dim", "code", "c"]
    return classes.select("c", "label", "dim", "unit") \
        .mapInArrow(coded, "pass int, label string, dim int, code long, c long, unit binary") \
        .repartitionByRange(parts or range_parts(classes), *order).sortWithinPartitions(*order) \
        .mapInArrow(windows, "a long, b long, sure boolean, gain double")


def _settled_pairs(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Those of ``a, b`` whose cosine in double precision reaches the threshold."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [float(np.dot(np.frombuffer(x, "<f8"), np.frombuffer(y, "<f8"))) >= threshold - _EPS
                  for x, y in zip(b.column("ua").to_pylist(), b.column("ub").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(classes.select(F.col("c").alias("a"), F.col("unit").alias("ua")), "a") \
        .join(classes.select(F.col("c").alias("b"), F.col("unit").alias("ub")), "b") \
        .select("a", "b", "ua", "ub").mapInArrow(exact, "a long, b long")


def whole_links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b`` linked, from all pairs of each group ``lead`` (as many as keep
    each tile's links connected)."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in runs(batches, ["lead", "i", "j"]):
            c, mine, i, j = (t[k].to_numpy() for k in ("c", "mine", "i", "j"))
            raw = t["unit"].to_pylist()
            found: list[np.ndarray] = []
            for lo, hi in zip(edges, edges[1:]):
                x = np.frombuffer(b"".join(raw[lo:hi]), dtype="<f8").reshape(hi - lo, -1)
                left, right = np.flatnonzero(mine[lo:hi] == i[lo]), np.flatnonzero(mine[lo:hi] == j[lo])
                other = x[right].T
                part = np.arange(hi - lo)           # the tile's components so far
                for s in range(0, len(left), 512):
                    own = left[s:s + 512]
                    near = x[own] @ other >= threshold - _EPS
                    p, q = _joined(near, part, own, right)
                    if p:
                        me, mate = c[lo + np.array(p)], c[lo + np.array(q)]
                        found.append(np.column_stack([np.minimum(me, mate), np.maximum(me, mate)]))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})

    keys = ["lead", "i", "j"]
    tiles = tiled(classes.select("lead", "c", "unit"), "lead", "c", WHOLE)
    return tiles.select(*keys, "mine", "c", "unit").repartitionByRange(range_parts(tiles), *keys) \
        .sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long")


def _links(classes: DataFrame, threshold: float, window: int, miss: float) -> DataFrame | None:
    """``a, b``: links that connect each component; None if no label has two vectors."""
    alone = written(classes.groupBy("label", "dim").agg(F.count("*").alias("n")).filter("n > 1"), "vector-sizes")
    todo = classes.select("c", "label", "dim", "unit").join(alone.select("label", "dim"), ["label", "dim"], "left_semi")
    links, gains, done = None, None, 0
    while (n := todo.count()):
        some = MORE_PASSES if done else FIRST_PASSES
        out = written(pass_links(todo, list(range(done, done + some)), threshold, window,
                                 max(1, -(-n * some // TASK_ROWS))), "vector-passes")
        done += some
        own = out.filter("sure").select("a", "b").union(_settled_pairs(
            out.filter("not sure").select("a", "b").distinct(), classes, threshold)).distinct()
        links = own if links is None else links.union(own)
        more = out.filter("b is null").select(F.col("a").alias("c"), "gain")
        gains = written((more if gains is None else gains.union(more)).groupBy("c").agg(F.sum("gain").alias("gain")),
                        "vector-gains")
        # of two vectors, the first to leave had the other in all its passes
        todo = written(todo.join(gains.filter(F.col("gain") >= -math.log(miss)), "c", "left_anti"), "vector-todo")
        if done < SETTLE:
            continue
        sizes = written(todo.groupBy("label", "dim").agg(F.count("*").alias("n"), F.min("c").alias("lead")),
                        "vector-sizes")
        few = sizes.filter(F.col("n") <= WHOLE * done)
        links = links.union(written(whole_links(todo.join(few.select("label", "dim", "lead"), ["label", "dim"]), threshold)
                                    .distinct(), "vector-whole"))
        todo = written(todo.join(few.select("label", "dim"), ["label", "dim"], "left_anti"), "vector-todo")
    return links


def _link_counts(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """``c, links``: rows of other classes within the threshold, from all
    pairs of each component."""
    members = classes.join(roots, F.col("c") == F.col("node")).select("root", "c", "rows", "unit")
    tiles = tiled(members, "root", "c", BLOCK)

    def count(t: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(t["unit"].to_pylist()), dtype="<f8").reshape(t.num_rows, -1)
        c, rows, mine = t["c"].to_numpy(), t["rows"].to_numpy(), t["mine"].to_numpy()
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        links = np.zeros(t.num_rows, dtype=np.int64)
        left = np.flatnonzero(mine == i)
        right = np.flatnonzero(mine == j)
        for s in range(0, len(left), 1024):
            own = left[s:s + 1024]
            near = (x[own] @ x[right].T >= threshold - _EPS) & (c[own][:, None] != c[right][None, :])
            links[own] += near @ rows[right]
            if i != j:
                links[right] += rows[own] @ near
        return pa.table({"c": c.astype(np.int64), "links": links})

    spread = tiles.repartitionByRange(range_parts(tiles), "root", "i", "j")
    return spread.groupBy("root", "i", "j").applyInArrow(count, "c long, links long") \
        .groupBy("c").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS,
                 vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("v")) \
        .withColumns({"h": F.xxhash64("v"), "k": F.xxhash64(F.lit(1), "v")})
    classes = _units(rows)
    links = _links(classes, threshold, window, miss)
    key = ["label", "h", "k"]
    if links is None:
        named = classes.select(*key, "rows", F.lit(0).cast("long").alias("links"), F.col("id").alias("root_id"))
    else:
        roots = connected_components(links, "vector")
        counts = _link_counts(classes, roots, threshold)
        lead = classes.select(F.col("c").alias("root"), F.col("id").alias("root_id"))
        named = classes.join(roots, F.col("c") == F.col("node"), "left").join(counts, "c", "left") \
            .select(*key, "rows", "links", F.coalesce("root", "c").alias("root")).join(lead, "root")
    named = written(named.select(*key, "rows", "links", "root_id"), "vector-named")
    out = rows.select("id", *key).join(named, key, "left")
    component = F.coalesce("root_id", "id")
    return out.select(F.col("id").alias("vec_id"),
                      (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("rows") - 1, F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


VECTOR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
n AS (SELECT *, sqrt(list_inner_product(e, e)) AS len FROM v WHERE label IS NOT NULL),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.len > 0 AND b.len > 0 AND list_inner_product(a.e, b.e) / (a.len * b.len) >= 0.93),
r AS (
  SELECT vec_id AS id, vec_id AS reach FROM v
  UNION SELECT r.id, l.b FROM r JOIN l ON r.reach = l.a),
m AS (SELECT id, min(reach) AS root FROM r GROUP BY id)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id)::BIGINT AS n_links, m.root AS component_id,
       v.vec_id = m.root AS kept
FROM v JOIN m ON m.id = v.vec_id
"""
