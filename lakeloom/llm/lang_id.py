"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (1 to 3 code points, ASCII letters lowered,
hashed to ``BUCKETS``), weighted by TF-IDF: the share of the text's n-grams
times the inverse document frequency. Document frequencies are counted over
all labelled documents. Weights are fitted with follow-the-regularised-leader
(per-coordinate rates, L1 and L2 penalty) on a bounded sample of them,
``MAX_SAMPLE`` different documents in all, spread evenly over the languages and
chosen by a hash of the text, before they reach the driver; a fifth of the sample is left out and sets the temperature
that calibrates the scores. Prediction reads every whole text.

A text that is null or has no letter is ``und`` with score 0, and so is every
text when no labelled document was given. Repeated rows get equal answers;
extra columns pass through untouched (``lang_pred`` and ``score`` are
replaced). The number of languages is taken to be small (a class weight matrix
is a few MB for a hundred).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import chunks, prepare, written

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Bound on the labelled documents that fit the weights.
MAX_SAMPLE = 2400
_LETTER = r"\p{L}"


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket of the n-gram that starts at each character, for each order
    (``BUCKETS`` where none fits before its text ends), and the character
    offsets of the rows."""
    if not len(data):
        return [np.zeros(0, dtype=np.int32) for _ in ORDERS], np.zeros(len(offs), dtype=np.int64)
    lead = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead)])[offs]
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    cp = np.where((cp >= 65) & (cp <= 90), cp + np.uint32(32), cp)
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(cp))
    out, h = [], np.zeros(len(cp), dtype=np.uint32)
    for n in ORDERS:
        own = np.zeros(len(cp), dtype=np.uint32)
        own[:len(cp) - n + 1] = cp[n - 1:]
        h = (h ^ own) * np.uint32(0x01000193) + np.uint32(0x9E3779B1 * n & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        bucket = ((h * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.int32)
        out.append(np.where(left >= n, bucket, BUCKETS))
    return out, at


def _counts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, count)`` of the distinct buckets of each row."""
    grams, at = _grams(data, offs)
    row = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at)) << 32
    keys = np.concatenate([(row | g)[g < BUCKETS] for g in grams])
    keys.sort()
    if not len(keys):
        return (np.zeros(0, np.int64),) * 3
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[edge] >> 32, keys[edge] & 0xFFFFFFFF, np.diff(np.append(edge, len(keys)))


@dataclass
class Model:
    """Languages, one column of weights for each, their offsets, and the
    temperature. ``weights`` already holds the inverse document frequencies."""

    langs: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + 1, 0), np.float32))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0

    def logits(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        grams, at = _grams(data, offs)
        n = np.diff(at)
        total = np.zeros((len(n), len(self.langs)))
        full = np.flatnonzero(n > 0)
        if len(full):
            own = sum(self.weights[g] for g in grams)
            total[full] = np.add.reduceat(own, at[:-1][full], axis=0, dtype=np.float64)
        size = sum(np.maximum(n - k + 1, 0) for k in ORDERS)
        return total / np.maximum(size, 1)[:, None] + self.offset


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _follow_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4,
                   alpha: float = 0.3, beta: float = 1e-3, l1: float = 1e-4, l2: float = 1e-3
                   ) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net; each row is (buckets, values, class).
    The last bucket is the offset. Returns weights and their non-zero mask."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1, 0.0,
                        -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    rng = np.random.default_rng(17)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(at)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            sq = g * g
            z[at] += g - (np.sqrt(n[at] + sq) - np.sqrt(n[at])) / alpha * w
            n[at] += sq
    return weights(slice(None)), n > 0


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The factor under the logits with the smallest held-out loss (golden
    section on its logarithm). As in Platt scaling the true class counts
    ``(n + 1) / (n + 2)``, else separable languages would get scores of 1."""
    n, classes = logits.shape
    want = np.full(logits.shape, 1 / (n + 2) / (classes - 1))
    want[np.arange(n), y] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float((want * (np.log(np.exp(z).sum(axis=1, keepdims=True)) - z)).sum(axis=1).mean())

    lo, hi, r = -5.0, 3.0, (5 ** 0.5 - 1) / 2
    a, b = hi - r * (hi - lo), lo + r * (hi - lo)
    for _ in range(60):
        if loss(a) <= loss(b):
            hi, b = b, a
            a = hi - r * (hi - lo)
        else:
            lo, a = a, b
            b = lo + r * (hi - lo)
    return float(np.exp((lo + hi) / 2))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_sample: int = MAX_SAMPLE) -> Model:
    """Learn from the rows of ``labelled`` whose language is not null."""
    spark = labelled.sparkSession
    prepare(spark)
    own = labelled.filter(F.col(lang).isNotNull()) \
        .select(F.coalesce(F.col(text), F.lit("")).alias("t"), F.col(lang).alias("l")) \
        .filter(F.col("t").rlike(_LETTER)) \
        .withColumns({"h": F.xxhash64(F.lit(5), "t"), "k": F.xxhash64(F.lit(6), "t")})
    keys = written(own.select("l", "h", "k").distinct(), "lang-keys")      # copies count once
    sizes = {r["l"]: r["count"] for r in keys.groupBy("l").count().collect()}
    if not sizes:
        return Model()
    langs = sorted(sizes)
    each = max(10, max_sample // len(langs))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for b in batches:
            n += b.num_rows
            for _, _, data, offs in chunks(b.column("t")):
                total += np.bincount(_counts(data, offs)[1], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": np.append(seen, BUCKETS).astype(np.int32),
                                          "n": np.append(total[seen], n)})

    df = own.select("t").mapInArrow(frequencies, "bucket int, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()      # at most BUCKETS + 1 rows
    found = np.zeros(BUCKETS + 1)
    found[df["bucket"].to_numpy()] = df["n"].to_numpy()
    idf = np.log((1 + found[BUCKETS]) / (1 + found[:BUCKETS])) + 1.0

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in chunks(b.column("t")):
                row, bucket, count = _counts(data, offs)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_pydict({
                    "l": b.column("l").slice(i, j - i), "h": b.column("h").slice(i, j - i),
                    "bucket": [bucket[a:z].astype("<i4").tobytes() for a, z in zip(cut, cut[1:])],
                    "count": [count[a:z].astype("<i4").tobytes() for a, z in zip(cut, cut[1:])]})

    # hashes small enough to be among the smallest (short of them about once
    # in a billion), and of those the smallest of each language
    enough = each + 6 * each ** 0.5 + 10
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, enough / sizes[k]))])
    place = F.shiftrightunsigned("h", 11)
    few = keys.filter(place / float(1 << 53) < F.element_at(share, F.col("l"))) \
        .withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy(place, "h", "k"))) \
        .filter(F.col("n") <= each).drop("n")
    chosen = own.join(F.broadcast(written(few, "lang-sample")), ["l", "h", "k"], "left_semi") \
        .dropDuplicates(["l", "h", "k"]).select("t", "l", "h")
    got = sorted(chosen.mapInArrow(vectors, "l string, h long, bucket binary, count binary").collect(),
                 key=lambda r: (r["h"], r["l"]))
    taken: dict[str, int] = {}
    train, held = [], []
    for r in got:
        taken[r["l"]] = k = taken.get(r["l"], 0) + 1
        at = np.frombuffer(r["bucket"], dtype="<i4")
        tf = np.frombuffer(r["count"], dtype="<i4").astype(np.float64)
        x = np.append(tf / tf.sum() * idf[at], 1.0)
        row = (np.append(at, BUCKETS), x, langs.index(r["l"]))
        (held if k % 5 == 0 else train).append(row)
    held = held or train
    w, _ = _follow_leader(train, len(langs))
    logits = np.array([x @ w[at] for at, x, _ in held])
    temperature = _temperature(logits, np.array([y for _, _, y in held])) if len(langs) > 1 else 1.0
    weights = np.zeros((BUCKETS + 1, len(langs)), dtype=np.float32)
    weights[:BUCKETS] = w[:BUCKETS] * idf[:, None]
    return Model(langs, weights, w[BUCKETS].copy(), temperature)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f"c{i}" for i in range(len(kept))]
    at = names[[f.name for f in kept].index(text)]
    src = docs.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names)])
    src = src.withColumn("letter", F.coalesce(F.col(at).rlike(_LETTER), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best = np.full(b.num_rows, "und", dtype=object)
            score = np.zeros(b.num_rows)
            if model.langs:
                letter = b.column("letter").to_numpy(zero_copy_only=False)
                for i, j, data, offs in chunks(b.column(at)):
                    p = _softmax(model.logits(data, offs) / model.temperature)
                    k = p.argmax(axis=1)
                    own = letter[i:j]
                    best[i:j] = np.where(own, np.array(model.langs, dtype=object)[k], "und")
                    score[i:j] = np.where(own, p[np.arange(j - i), k], 0.0)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(best, pa.string()),
                                              pa.array(score)], [*names, "lang_pred", "score"])

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for f, n in zip(kept, names))
    out = src.mapInArrow(run, fields + ", lang_pred string, score double")
    return out.select(*[F.col(n).alias(f.name) for f, n in zip(kept, names)], "lang_pred", "score")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is known: the text has a letter and,
    where a model could be learned, its language scores ``min_score`` or is the
    one that the row names in ``lang``."""
    model = fit(docs.filter(~held_out()))
    ok = F.col("lang_pred") != "und" if model.langs else F.coalesce(F.col("text").rlike(_LETTER), F.lit(False))
    if len(model.langs) > 1:
        ok = ok & ((F.col("score") >= min_score) | F.col("lang_pred").eqNullSafe(F.col("lang")))
    return predict(docs, model).filter(ok).select(*[F.col(f"`{c}`") for c in docs.columns])
