"""Mixing sources to target weights by Pareto order sampling.

The mix is 150 % of all words. Sources, in order of their names (null last),
weigh 3, 1, 2, repeating; a source's target stops at twice its own size and
what exceeds it is shared again by weight. Within a source every document
first gets the whole copies that the target allows for all. The rest of the
target is drawn without replacement, with inclusion probabilities in
proportion to size (a document whose share would exceed one is certain):
documents are ranked by random odds divided by inclusion odds, and the ranking
is taken up to the document that brings the words nearest to the target.

Only DataFrame functions are used. No task holds a whole source: inclusion
probabilities come from the distinct sizes, running sums from ranges of the
ranking.

A word is ``[^\\x20\\x09-\\x0D]+``. Null text has size 0; a null source is one
source. The draw of a row depends on its doc_id, text and ``seed`` only, so
reruns agree and repeated rows are drawn together. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import range_buckets, running_before, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Sources up to which their parameters are broadcast (about 100 bytes each).
BROADCAST_SOURCES = 50_000
_MIX = ("_src", "_size", "_u", "_doc", "_key")


def size_of(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _digest(doc_id: Column, text: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """Source, size and the draw's uniform number (52 bits of a digest)."""
    key = _digest(F.col("doc_id"), F.col("text"), seed)
    return docs.withColumns({"_src": F.col("source").cast("string"), "_size": size_of(F.col("text")),
                             "_doc": F.col("doc_id").cast("long"), "_key": key}) \
        .withColumn("_u", (F.conv(F.substring("_key", 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """``_src, _total`` to ``_src, _total, _target``: the smallest common
    level at which ``min(most * size, level * weight)`` uses up the share."""
    named = Window.orderBy(F.col("_src").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("_src", "_total", w.alias("_w")).withColumn("_cap", (F.col("_total") * most).cast("double"))
    rank = Window.orderBy((F.col("_cap") / F.col("_w")), F.col("_src").asc_nulls_last())
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    after = rank.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    s = s.withColumn("_level", (F.sum("_total").over(every) * share
                                - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / F.sum("_w").over(after))
    s = s.withColumn("_common", F.max(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"),
                                             F.col("_level"))).over(every))   # the first that fits
    return s.select("_src", "_total", F.least("_cap", F.coalesce("_common", F.lit(float("inf")))
                                              * F.col("_w")).alias("_target"))


def _inclusion(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source its whole copies, the words left to draw, and the
    probability per word: documents larger than ``_certain`` are sure."""
    whole = F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(0)
    t = targets.withColumn("_whole", whole.cast("long")) \
        .withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_total"))
    d = "decimal(38,0)"
    sizes = sized.filter("_size > 0").groupBy("_src", "_size").agg(F.count("*").alias("_n"))
    joined = sizes.alias("s").join(t.alias("t"), F.col("s._src").eqNullSafe(F.col("t._src"))) \
        .select("s.*", "t._rest")
    w = Window.partitionBy("_src").orderBy(F.col("_size").desc())
    words = F.col("_n").cast(d) * F.col("_size").cast(d)
    sure = F.coalesce(F.sum(words.cast(d)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum((words * F.col("_size").cast(d)).cast(d)).over(w.rowsBetween(0, Window.unboundedFollowing))
    rate = (F.col("_rest") - sure.cast("double")) / squares.cast("double")
    r = joined.withColumn("_rate", rate).filter(F.col("_rate") * F.col("_size") <= 1) \
        .groupBy("_src").agg(F.max(F.struct("_size", "_rate")).alias("_r"))
    return t.alias("t").join(r.alias("r"), F.col("t._src").eqNullSafe(F.col("r._src")), "left") \
        .select("t.*", F.coalesce(F.col("_r._size"), F.lit(0)).alias("_certain"),
                F.coalesce(F.col("_r._rate"), F.lit(0.0)).alias("_rate"))


def _order() -> Column:
    """Random odds over inclusion odds; 0 for certain documents."""
    p = F.col("_rate") * F.col("_size")
    return F.when(F.col("_size") > F.col("_certain"), F.lit(0.0)) \
        .when((F.col("_size") == 0) | (p <= 0), F.lit(float("inf"))) \
        .when(p >= 1, F.lit(0.0)) \
        .otherwise((F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p)))


def _with_source(rows: DataFrame, params: DataFrame) -> DataFrame:
    small = F.broadcast(params) if params.count() <= BROADCAST_SOURCES else params
    names = [c for c in params.columns if c != "_src"]
    return rows.alias("d").join(small.alias("p"), F.col("d._src").eqNullSafe(F.col("p._src")), "left") \
        .select("d.*", *[f"p.{c}" for c in names])


def _mixed(rows: DataFrame, meta: DataFrame, weights: tuple, share: float, most: int) -> DataFrame:
    """``rows`` (of :func:`_sized`) with ``size, source_size, target, copies,
    taken``; everything is decided on ``meta``, the same rows without texts."""
    targets = source_targets(meta.groupBy("_src").agg(F.sum("_size").alias("_total")), weights, share, most)
    params = written(_inclusion(meta, targets), "mix-sources")
    ranked = _with_source(meta, params).withColumn("_q", _order()).filter("_size > 0 and _q < double('inf')")
    # rows that repeat doc_id and text are one entry of the ranking; the cut takes them one by one
    folded = ranked.groupBy("_src", "_key", "_size", "_q", "_rest").agg(F.count("*").alias("_rows")) \
        .withColumn("_all", F.col("_size") * F.col("_rows"))
    order = [F.col("_q"), F.col("_key")]
    ranked = running_before(range_buckets(folded, order, "mix-rank"), ["_src"], order, "_all", "_before")
    guess = F.floor((F.col("_rest") - F.col("_before")) / F.col("_size") + 0.5)

    def fits(k: Column) -> Column:              # whether the k-th of the rows (from 1) comes nearer to the target
        return F.col("_before") + (k - 1) * F.col("_size") + F.col("_size") / 2 <= F.col("_rest")

    fit = F.when(fits(guess + 1), guess + 1).when(fits(guess), guess).otherwise(guess - 1)
    ranked = ranked.withColumn("_fit", F.least(F.col("_rows"), fit))
    last = ranked.filter("_fit >= 1").groupBy("_src").agg(F.max(F.struct("_q", "_key", "_fit", "_rows")).alias("_last"))
    cut = written(params.alias("a").join(last.alias("b"), F.col("a._src").eqNullSafe(F.col("b._src")), "left")
                  .select("a.*", "b._last"), "mix-cut")
    ours = _with_source(rows, cut).withColumn("_q", _order())
    here, end = F.struct("_q", "_key"), F.struct(F.col("_last._q").alias("_q"), F.col("_last._key").alias("_key"))
    split = F.coalesce((here == end) & (F.col("_last._fit") < F.col("_last._rows")), F.lit(False))

    def counted(df: DataFrame, drawn: Column) -> DataFrame:
        copies = F.col("_whole") + drawn.cast("long")
        return df.select(*[F.col(f"`{c}`") for c in rows.columns if c not in _MIX], F.col("_size").alias("size"),
                         F.col("_total").alias("source_size"), F.col("_target").alias("target"),
                         copies.alias("copies"), (F.col("_size") * copies).alias("taken"))

    if cut.filter("_last._fit < _last._rows").isEmpty():
        return counted(ours, F.coalesce(here <= end, F.lit(False)))
    # the rows that the cut falls among, in an order of their other columns (rows that are all equal: any)
    others = F.to_json(F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in rows.columns if c not in (*_MIX, "text")]),
                       {"ignoreNullFields": "false"})
    among = written(ours.filter(split).withColumns({"_h": F.xxhash64(others), "_salt": F.rand(),
                                                    "_one": F.lit(1).cast("long")}), "mix-among")
    place = [F.col("_h"), F.col("_salt")]
    placed = running_before(range_buckets(among, [F.col("_key"), *place], "mix-place"), ["_src", "_key"], place,
                            "_one", "_rank")
    return counted(ours.filter(~split), F.coalesce(here <= end, F.lit(False))) \
        .unionByName(counted(placed, F.col("_rank") < F.col("_last._fit")))


def _measured(docs: DataFrame, seed: int) -> DataFrame:
    """Source, size and draw of each row, written: texts are read once for
    all passes over the numbers."""
    return written(_sized(docs, seed).select("doc_id", *_MIX), "mix-sizes")


def mix(docs: DataFrame, seed: int = 0, weights: tuple = WEIGHTS, share: float = SHARE,
        most: int = MOST) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken`` (``size * copies``); columns of these
    names are replaced."""
    ours = ("size", "source_size", "target", "copies", "taken")
    own = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ours])
    return _mixed(_sized(own, seed), _measured(docs, seed), weights, share, most)


def mix_sizes(docs: DataFrame, seed: int = 0, weights: tuple = WEIGHTS, share: float = SHARE,
              most: int = MOST) -> DataFrame:
    """The mix as numbers only: ``doc_id, size, source_size, target, copies,
    taken``."""
    meta = _measured(docs, seed)
    return _mixed(meta, meta, weights, share, most)


def mixed_copies(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it."""
    kept = docs.select("doc_id", "text", "source",
                       *[F.col(f"`{c}`").alias(f"_own{i}") for i, c in enumerate(docs.columns)])
    return mix(kept, seed).filter("copies > 0") \
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))) \
        .select(*[F.col(f"_own{i}").alias(c) for i, c in enumerate(docs.columns)])


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('0|' || doc_id || '|' || md5(coalesce(text, ''))) AS k FROM documents),
u AS (SELECT *, (('0x' || substr(k, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS total,
         list_extract([3.0::DOUBLE, 1.0, 2.0], (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS w
  FROM d GROUP BY source),
c AS (SELECT *, (2 * total)::DOUBLE AS cap FROM s),
l AS (
  SELECT *, ((SELECT sum(total) FROM s)::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM c),
t AS (
  SELECT source, total, least(cap, coalesce((SELECT max(lev) FROM l WHERE lev <= cap / w), 'inf'::DOUBLE) * w) AS target
  FROM l),
p AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, target - whole * total AS rest FROM p),
z AS (SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
r AS (
  SELECT z.source, z.size, (q.rest - coalesce(sum(n * z.size) OVER (PARTITION BY z.source ORDER BY z.size DESC
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(n * z.size * z.size) OVER (PARTITION BY z.source ORDER BY z.size DESC
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate
  FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source),
m AS (SELECT source, max({'a': size, 'b': rate}) AS best FROM r WHERE rate * size <= 1 GROUP BY source),
x AS (
  SELECT u.*, q.total, q.target, q.whole, q.rest, coalesce(m.best.a, 0) AS sure, coalesce(m.best.b, 0) AS rate
  FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source LEFT JOIN m ON u.source IS NOT DISTINCT FROM m.source),
o AS (
  SELECT *, CASE WHEN size > sure THEN 0 WHEN size = 0 OR rate * size <= 0 THEN 'inf'::DOUBLE
         WHEN rate * size >= 1 THEN 0 ELSE (u / (1 - u)) / ((rate * size) / (1 - rate * size)) END AS odds FROM x),
a AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds, k
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o)
SELECT doc_id, size::BIGINT AS size, total AS source_size, target,
       (whole + CASE WHEN size > 0 AND odds < 'inf'::DOUBLE AND before + size / 2::DOUBLE <= rest THEN 1 ELSE 0 END)::BIGINT AS copies,
       (size * (whole + CASE WHEN size > 0 AND odds < 'inf'::DOUBLE AND before + size / 2::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM a
"""
