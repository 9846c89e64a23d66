"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, the weight S of a term is how often it
occurs. Sample k draws for each term two gamma variates r, c ~ Gamma(2, 1) and
an offset b ~ U(0, 1) from a hash of the term and k, takes
t = floor(ln S / r + b) and ln a = ln c - r (t - b) - r, and keeps the smallest
ln a of the text. That value depends on the term, k and t alone, so two texts
agree in a sample exactly when they chose the same term at the same t, which
happens with probability equal to their generalised Jaccard similarity
(sum of the smaller over sum of the larger weights). The likeness of two
fingerprints is the share of equal samples.

Only DataFrame functions are used. Texts are shuffled once, by document; the
terms of a document are counted and sampled where its text lies.

Words are ``[^\\x20\\x09-\\x0D]+``; a null text is empty, and a text without
words has one empty term, so empty texts are alike. Rows that repeat doc_id
and text are one document, returned as often as they occur. Equal doc_ids are
ordered by a hash of the text, a null doc_id comes last; the document after the
last is the first (a single document follows itself). Empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import range_buckets, written

SAMPLES = 32
_SPACE = r"[\x20\x09-\x0D]+"


def _uniforms(h: Column) -> tuple[Column, Column]:
    """Two uniform numbers in (0, 1) from the halves of a 64-bit hash."""
    return ((F.shiftrightunsigned(h, 32) + 0.5) / 4294967296.0,
            (h.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) / 4294967296.0)


def _sample(term: Column, log_weight: Column, k: int) -> Column:
    """ln a of one term in sample ``k``."""
    u1, u2 = _uniforms(F.xxhash64(F.lit(3 * k), term))
    v1, v2 = _uniforms(F.xxhash64(F.lit(3 * k + 1), term))
    b, _ = _uniforms(F.xxhash64(F.lit(3 * k + 2), term))
    r = -F.ln(u1 * u2)
    t = F.floor(log_weight / r + b)
    return F.ln(-F.ln(v1 * v2)) - r * (t - b) - r


def signatures(texts: DataFrame, keys: list[str], text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``sample`` (array of ``samples`` doubles) of each distinct
    key. Where ``texts`` is already partitioned by some of ``keys``, nothing
    is shuffled."""
    words = F.split(F.coalesce(F.col(text), F.lit("")), _SPACE)
    texts = texts.select(*keys, F.filter(words, lambda w: w != "").alias("_words"))
    words = F.when(F.size("_words") > 0, F.col("_words")).otherwise(F.array(F.lit("")))
    # a text's terms are counted in its own row, as runs of its sorted hashes,
    # so that no aggregation holds a row per term
    hashed = texts.select(*keys, F.sort_array(F.transform(words, lambda w: F.xxhash64(w))).alias("_terms"))
    begun = hashed.select(*keys, "_terms", F.filter(
        F.sequence(F.lit(0), F.size("_terms") - 1),
        lambda i: (i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1))).alias("_at"))
    counted = begun.select(*keys, F.inline_outer(F.transform("_at", lambda p, k: F.struct(
        F.get("_terms", p).alias("_w"), (F.coalesce(F.get("_at", k + 1), F.size("_terms")) - p).alias("_n")))))
    logs = counted.select(*keys, "_w", F.ln(F.col("_n").cast("double")).alias("_s"))
    least = logs.groupBy(*keys).agg(*[F.min(_sample(F.col("_w"), F.col("_s"), k)).alias(f"_m{k}")
                                      for k in range(samples)])
    return least.select(*keys, F.array(*[f"_m{k}" for k in range(samples)]).alias("sample"))


def fingerprint(sample: Column) -> Column:
    """Text form of a signature: eight hex digits per sample."""
    return F.array_join(F.transform(sample, lambda v: F.right(F.lpad(F.hex(F.xxhash64(v)), 16, "0"), F.lit(8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two signatures (0 to 1)."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)


#: A document's key; no part is null, so joins and groupings share one shuffle.
_KEY = ["_null", "_id", "_h"]


def _chain(docs: DataFrame) -> DataFrame:
    """Key of each distinct document with its length, its rows, its
    successor's key and its predecessor's key and length, in ascending order
    of doc_id."""
    key = _KEY
    meta = written(docs.select(*key, F.char_length("_t").cast("long").alias("_len")).groupBy(*key, "_len")
                   .agg(F.count("*").alias("_rows")), "prints-keys")
    order = [F.col(c) for c in key]
    held = range_buckets(meta, order, "prints-order")
    me = F.struct(*key, "_len")
    w = Window.partitionBy("_bucket").orderBy(*order)
    own = held.select("*", F.lag(me).over(w).alias("_prev"), F.lead(me).over(w).alias("_next"))
    # the ends of each range meet the neighbouring ranges; the last meets the first
    ends = held.groupBy("_bucket").agg(F.min(me).alias("_lo"), F.max(me).alias("_hi"))
    e = Window.orderBy("_bucket")
    every = e.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("_bucket", F.coalesce(F.lag("_hi").over(e), F.last("_hi").over(every)).alias("_before"),
                       F.coalesce(F.lead("_lo").over(e), F.first("_lo").over(every)).alias("_after"))
    full = own.join(ends, "_bucket").select(
        *key, "_len", "_rows", F.coalesce("_prev", "_before").alias("_prev"),
        F.coalesce("_next", "_after").alias("_next"))
    return written(full.select(*key, "_len", "_rows", *[F.col(f"_prev.{c}").alias(f"_p{c}") for c in (*key, "_len")],
                               *[F.col(f"_next.{c}").alias(f"_n{c}") for c in key]), "prints-chain")


def _on(a: str, b: str, left: str = "", right: str = "") -> Column:
    """Equal keys; ``left`` and ``right`` prefix the names of the columns."""
    same = [F.col(f"{a}.{left}{c}") == F.col(f"{b}.{right}{c}") for c in _KEY]
    return same[0] & same[1] & same[2]


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, whose last quarter
    (in code points, rounded down) is replaced by the first as many code
    points, or all, of the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    name = F.col(doc_id).cast("long")
    own = docs.select(name.isNull().alias("_null"), F.coalesce(name, F.lit(0).cast("long")).alias("_id"),
                      F.xxhash64(t).alias("_h"), t.alias("_t"))
    chain = _chain(own)
    repeated = not chain.filter("_rows > 1").isEmpty()
    if repeated:
        own = own.dropDuplicates(_KEY)
    mine = [f"d.{c}" for c in _KEY]
    placed = own.alias("d").join(chain.alias("c"), _on("d", "c")) \
        .select(*mine, "d._t", "c._len", *[f"c._p{c}" for c in (*_KEY, "_len")])
    heads = placed.select(*[f"_p{c}" for c in _KEY], F.substring(
        "_t", F.lit(1), F.floor(F.col("_p_len") / 4).cast("int")).alias("_head"))
    cut = F.floor(F.col("d._len") / 4)
    edited = F.concat(F.substring(F.col("d._t"), F.lit(1), (F.col("d._len") - cut).cast("int")), F.col("h._head"))
    both = placed.alias("d").join(heads.alias("h"), _on("d", "h", "", "_p")) \
        .select(*mine, "d._t", edited.alias("_e"))
    texts = both.select(*_KEY, F.explode(F.array(
        F.struct(F.lit(False).alias("_edit"), F.col("_t").alias("text")),
        F.struct(F.lit(True).alias("_edit"), F.col("_e").alias("text")))).alias("v")) \
        .select(*_KEY, "v._edit", "v.text")
    signed = signatures(texts, [*_KEY, "_edit"], "text", samples)
    per_doc = signed.groupBy(*_KEY).agg(
        F.max(F.when(~F.col("_edit"), F.col("sample"))).alias("_s"),
        F.max(F.when(F.col("_edit"), F.col("sample"))).alias("_es"))
    hashes = both.select(*_KEY, F.unhex(F.sha2(F.col("_e"), 256)).alias("_sha"))
    done = written(per_doc.join(hashes, _KEY), "prints")
    nexts = chain.alias("c").join(done.alias("n"), _on("c", "n", "_n")) \
        .select(*[f"c.{c}" for c in _KEY], "c._len", "c._rows", F.col("n._s").alias("_ns"))
    out = done.join(nexts, _KEY)
    if repeated:
        out = out.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    return out.select(F.when(~F.col("_null"), F.col("_id")).alias("doc_id"), F.col("_len").alias("n_chars"),
                      F.lower(F.hex("_sha")).alias("edited_sha256"), fingerprint(F.col("_s")).alias("fingerprint"),
                      fingerprint(F.col("_es")).alias("edited_fingerprint"),
                      likeness(F.col("_s"), F.col("_es")).alias("near_edited"),
                      likeness(F.col("_s"), F.col("_ns")).alias("near_next"))
