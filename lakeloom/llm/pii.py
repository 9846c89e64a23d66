"""Personal data: patterns, and terms of the corpus that disclose it.

Protected entities are the addresses, numbers and so on that four patterns find.
Beside them, information-theoretic sanitisation finds terms that give an entity
away. The corpus estimates, over all N documents, in how many a term stands
anywhere (``df``) and in how many within ``CONTEXT`` code points of an entity e
(``co``). Then p(e | t) = co / df, so the term leaves ``-log2(co / df)`` bits of
e's information unknown; its pointwise mutual information with e is
``log2(co * N / (df * df_e))``. A term discloses e if it leaves at most
``log2(5 / 4)`` bits, its mutual information is at least 3 bits, and at least
``SUPPORT`` different texts show it. Disclosing terms are marked wherever they
stand: :func:`sanitised` removes those that leave no doubt (co = df) and
generalises the others to their class, as it does with the entities.

Base patterns (kinds ``email ip card phone``), leftmost without overlaps, each
kind on its own; a match that fails its test (parts of an ip at most 255; 14 to
19 digits that pass Luhn's test; 10 to 15 digits of a phone) is dropped. The
patterns are written so that a text is scanned once: a run is entered at its
start only (or where the last match ended) and never given back.

A term is a run of letters and digits of at least ``SHORTEST`` code points. An
entity's context ends at the neighbouring matches of its kind; a term that the
context's outer edge cuts does not count. A term inside or across an entity is
not marked.

Only DataFrame functions are used. Positions come from running sums over the
pieces between matches, one text at a time and spilled like any window; rows of
equal texts are folded by two 64-bit hashes and their number, so copies do not
support a term and a hot text costs one row a task. Only candidates are counted
in the corpus (terms that ``SUPPORT`` texts show beside one entity).

A null text is empty, a null doc_id stays null; rows that repeat are returned
as often as they occur. Other columns are not looked at. Empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import written

#: Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TOKEN = r"[\p{L}\p{N}]+"
CONTEXT = 80
SHORTEST = 3
SUPPORT = 2
#: co / df at least SHARE[0] / SHARE[1]; p(e | t) / p(e) at least LIFT.
SHARE = (4, 5)
LIFT = 8
#: Rows up to which a table of terms or of text hashes is broadcast (terms are
#: words, so some 20 MB).
BROADCAST_KEYS = 300_000


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(t).alias("h"),
                       F.xxhash64(F.lit(1), t).alias("k"), t.alias("t"))


def _placed(pieces: DataFrame, group: list[str]) -> DataFrame:
    """``pos, len, value`` (the code points before a match, the match; null
    after the last) of texts to ``start, end``."""
    w = Window.partitionBy(*group).orderBy("pos")
    size = F.coalesce(F.length("value"), F.lit(0))
    end = F.sum(F.col("len") + size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return pieces.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - size)


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(turned, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds() -> Column:
    """Whether a match of ``kind, value`` passes the test of its kind."""
    parts = F.transform(F.split("value", r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    ip = F.forall(parts, lambda x: (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255))
    digits = F.regexp_replace("value", "[^0-9]", "")
    card = F.length(digits).between(14, 19) & _luhn(digits)
    return F.col("value").isNotNull() & F.when(F.col("kind") == "ip", ip).when(F.col("kind") == "card", card) \
        .when(F.col("kind") == "phone", F.length(digits).between(10, 15)).otherwise(True)


def _entities(texts: DataFrame, context: int) -> DataFrame:
    """Base spans of the different texts: ``h, k, kind, value, start, end,
    rows`` (documents with this text) and ``terms`` (of the context)."""
    found = texts.select("h", "k", "t", *[
        F.when(F.col("t").contains(_NEEDS[n]) if _NEEDS[n] else F.lit(True),
               F.regexp_extract_all("t", F.lit(PATTERN[n]), F.lit(0))).alias(n) for n in KINDS])
    kept = found.filter(" or ".join(f"size({n}) > 0" for n in KINDS))

    def pieces(kind: str) -> Column:
        zipped = F.arrays_zip(F.split("t", PATTERN[kind], -1).alias("part"), F.col(kind).alias("value"))
        out = F.transform(zipped, lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), F.length(x["part"]).alias("len"), x["value"].alias("value"),
            F.left(x["part"], F.lit(context + 1)).alias("head"), F.right(x["part"], F.lit(context + 1)).alias("tail")))
        return F.when(F.size(kind) > 0, out)

    none = F.array().cast("array<struct<kind:string,pos:int,len:int,value:string,head:string,tail:string>>")
    rows = kept.select("h", "k", F.explode(F.concat(*[F.coalesce(pieces(n), none) for n in KINDS])).alias("p")) \
        .select("h", "k", "p.*")
    rows = rows.groupBy("h", "k", "kind", "pos").agg(
        F.any_value(F.struct("len", "value", "head", "tail")).alias("p"), F.count("*").alias("rows"))
    placed = _placed(rows.select("h", "k", "kind", "pos", "rows", "p.*"), ["h", "k", "kind"])
    w = Window.partitionBy("h", "k", "kind").orderBy("pos")
    before = F.when(F.col("len") > context, F.regexp_replace("tail", rf"\A{TOKEN}", "")).otherwise(F.col("tail"))
    after = F.when(F.lead("len").over(w) > context, F.regexp_replace(F.lead("head").over(w), rf"{TOKEN}\z", "")) \
        .otherwise(F.lead("head").over(w))
    return placed.withColumn("context", F.concat(before, F.lit(" "), after)).filter(_holds()) \
        .select("h", "k", "kind", "value", "start", "end", "rows", _terms(F.col("context")).alias("terms"))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda x: F.length(x) >= SHORTEST))


def _small(keys: DataFrame) -> DataFrame:
    """Broadcast a written table of keys where it is small enough."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _holding(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``h, k, term`` of every row and each of its terms that is in ``terms``."""
    return texts.select("h", "k", F.explode(_terms(F.col("t"))).alias("term")).join(_small(terms), "term", "left_semi")


def _disclosing(texts: DataFrame, entities: DataFrame, n: int, support: int) -> DataFrame:
    """``term, sure`` of the disclosing terms."""
    shown = entities.select("h", "k", "kind", "value", "rows", F.explode("terms").alias("term")).distinct()
    beside = written(shown.groupBy("kind", "value", "term").agg(F.sum("rows").alias("co"), F.count("*").alias("texts"))
                     .filter(F.col("texts") >= support), "pii-beside")
    candidates = written(beside.select("term").distinct(), "pii-candidates")
    frequent = entities.select("h", "k", "kind", "value", "rows").distinct().groupBy("kind", "value") \
        .agg(F.sum("rows").alias("df_e"))
    df = _holding(texts, candidates).groupBy("term").agg(F.count("*").alias("df"))
    d = "decimal(38,0)"
    told = beside.join(df, "term").join(frequent, ["kind", "value"]).filter(
        (F.col("df") >= F.col("co")) & (F.col("co") * SHARE[1] >= F.col("df") * SHARE[0])
        & ((F.col("co").cast(d) * F.lit(n).cast(d)) >= (F.col("df").cast(d) * F.col("df_e").cast(d) * LIFT)))
    return written(told.groupBy("term").agg(F.max(F.col("co") == F.col("df")).alias("sure")), "pii-terms")


def _term_spans(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``h, k, start, end, sure`` of the terms in the different texts."""
    some = written(_holding(texts, terms).select("h", "k").distinct(), "pii-texts")
    parts = texts.join(_small(some), ["h", "k"], "left_semi").select(
        "h", "k", F.posexplode(F.arrays_zip(F.split("t", TOKEN, -1).alias("part"),
                                            F.regexp_extract_all("t", F.lit(TOKEN), F.lit(0)).alias("value")))) \
        .select("h", "k", "pos", F.length("col.part").alias("len"), F.col("col.value").alias("value"))
    placed = _placed(parts.dropDuplicates(["h", "k", "pos"]), ["h", "k"])
    return placed.join(_small(terms.withColumnRenamed("term", "value")), "value").select("h", "k", "start", "end", "sure")


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", context: int = CONTEXT,
               support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """``doc_id, h, k`` of every row, and ``h, k, spans`` of the texts that have
    any: ``start, rank, end, kind, sure`` by start, then kind."""
    texts = _texts(docs, doc_id, text)
    named = written(texts.select("doc_id", "h", "k"), "pii-rows")
    entities = written(_entities(texts, context), "pii-entities")
    terms = _disclosing(texts, entities, named.count(), support)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    base = entities.select("h", "k", "start", rank.alias("rank"), "end", "kind", F.lit(True).alias("sure"))
    more = _term_spans(texts, terms).select("h", "k", "start", F.lit(len(KINDS) + 1).alias("rank"), "end",
                                                  F.lit(TERM).alias("kind"), "sure")
    own = Window.partitionBy("h", "k")
    ahead = own.orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    behind = own.orderBy(F.col("start").desc(), F.col("rank").desc()).rowsBetween(Window.unboundedPreceding, -1)
    is_base = F.col("kind") != TERM
    both = base.unionByName(more).withColumns({
        "before": F.max(F.when(is_base, F.col("end"))).over(ahead),
        "after": F.min(F.when(is_base, F.col("start"))).over(behind)})
    free = is_base | ((F.coalesce(F.col("before"), F.lit(0)) <= F.col("start"))
                      & (F.col("after").isNull() | (F.col("after") >= F.col("end"))))
    spans = both.filter(free).groupBy("h", "k").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind", "sure"))).alias("spans"))
    return named, written(spans, "pii-spans")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def private_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", context: int = CONTEXT,
                  support: int = SUPPORT) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans`` of
    every row."""
    named, spans = find_spans(docs, doc_id, text, context, support)
    own = F.coalesce("spans", F.array())

    def count(kind: str) -> Column:
        return F.size(F.filter(own, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return named.join(spans, ["h", "k"], "left").select(
        "doc_id", *[count(n) for n in (*KINDS, TERM)],
        F.sha2(_joined(F.filter(own, lambda x: x["kind"] != TERM)), 256).alias("base_sha256"), _joined(own).alias("spans"))


def sanitised(docs: DataFrame, text: str = "text", context: int = CONTEXT, support: int = SUPPORT) -> DataFrame:
    """``docs`` with entities and terms generalised to ``<KIND>`` (``<WORD>`` or
    ``<NUMBER>``), terms that leave no doubt removed. Spans that overlap become
    one, under the first one's kind."""
    _, spans = find_spans(docs.select(F.lit(None).alias("doc_id"), F.col(f"`{text}`").alias("text")), context=context,
                          support=support)
    t = F.coalesce(F.col(f"d.`{text}`"), F.lit(""))
    joined = docs.alias("d").join(spans.alias("s"), (F.xxhash64(t) == F.col("s.h")) & (F.xxhash64(F.lit(1), t) == F.col("s.k")),
                                  "left")

    def write(state: Column, x: Column) -> Column:
        piece = F.substr(t, x["start"].cast("int") + 1, (x["end"] - x["start"]).cast("int"))
        mark = F.when(x["kind"] != TERM, F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))) \
            .when(x["sure"], "").when(piece.rlike(r"\A[0-9]+\z"), "<NUMBER>").otherwise("<WORD>")
        gap = F.substr(t, state["at"] + 1, F.greatest(x["start"].cast("int") - state["at"], F.lit(0)))
        out = F.when(x["start"] < state["at"], state["out"]).otherwise(F.concat(state["out"], gap, mark))
        return F.struct(out.alias("out"), F.greatest(state["at"], x["end"].cast("int")).alias("at"))

    clean = F.aggregate(F.col("s.spans"), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), write,
                        lambda s: F.concat(s["out"], F.substr(t, s["at"] + 1, F.length(t))))
    changed = F.when(F.col("s.spans").isNull(), F.col(f"d.`{text}`")).otherwise(clean)
    return joined.select(*[changed.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])


PII_SQL = r"""
WITH kinds(kind, rank, pattern) AS (VALUES
  ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'),
  ('ip', 2, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
  ('card', 3, '[0-9](?:[\x20-]?[0-9])+'), ('phone', 4, '\+[0-9][\x20().0-9-]+[0-9]')),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT t, count(*) AS n FROM d GROUP BY t),
m AS (SELECT t, kind, unnest(regexp_extract_all(t, pattern)) AS value,
             generate_subscripts(regexp_extract_all(t, pattern), 1) AS pos,
             string_split_regex(t, pattern) AS parts, regexp_extract_all(t, pattern) AS all_ FROM u, kinds),
p AS (SELECT t, kind, value, pos, parts[pos] AS part, parts[pos + 1] AS next,
             list_sum(list_transform(parts[1:pos], lambda x: length(x)))
             + coalesce(list_sum(list_transform(all_[1:pos - 1], lambda x: length(x))), 0) AS start,
             length(value) AS size, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM m),
e AS (SELECT *, CAST(start AS BIGINT) AS s, CAST(start + size AS BIGINT) AS f FROM p WHERE CASE kind
  WHEN 'ip' THEN list_bool_and(list_transform(string_split(value, '.'), lambda x: CAST(x AS DECIMAL(38,0)) <= 255))
  WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
  WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''),
    lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INT) WHEN CAST(x AS INT) > 4 THEN CAST(x AS INT) * 2 - 9
                 ELSE CAST(x AS INT) * 2 END)) % 10 = 0
  ELSE true END),
ctx AS (SELECT t, kind, value,
  CASE WHEN length(part) > 80 THEN regexp_replace(part[-81:], '\A[\p{L}\p{N}]+', '') ELSE part END || ' ' ||
  CASE WHEN length(next) > 80 THEN regexp_replace(next[1:81], '[\p{L}\p{N}]+\z', '') ELSE next END AS c FROM e),
shown AS (SELECT DISTINCT t, kind, value, term FROM
          (SELECT t, kind, value, unnest(regexp_extract_all(c, '[\p{L}\p{N}]+')) AS term FROM ctx) WHERE length(term) >= 3),
beside AS (SELECT kind, value, term, sum(n) AS co FROM shown JOIN u USING (t) GROUP BY ALL HAVING count(*) >= 2),
freq AS (SELECT kind, value, sum(n) AS df_e FROM (SELECT DISTINCT t, kind, value FROM e) JOIN u USING (t) GROUP BY ALL),
held AS (SELECT t, n, term FROM (SELECT t, n, unnest(list_distinct(regexp_extract_all(t, '[\p{L}\p{N}]+'))) AS term FROM u)
         WHERE term IN (SELECT term FROM beside)),
told AS (SELECT DISTINCT term FROM beside JOIN (SELECT term, sum(n) AS df FROM held GROUP BY term) USING (term)
         JOIN freq USING (kind, value)
         WHERE df >= co AND co * 5 >= df * 4 AND co * (SELECT count(*) FROM d) >= df * df_e * 8),
tok AS (SELECT t, string_split_regex(t, '[\p{L}\p{N}]+') AS parts, regexp_extract_all(t, '[\p{L}\p{N}]+') AS all_
        FROM u WHERE t IN (SELECT t FROM held JOIN told USING (term))),
run AS (SELECT t, value, sum(len + length(value)) OVER (PARTITION BY t ORDER BY pos) AS f FROM
        (SELECT t, unnest(all_) AS value, unnest(list_transform(parts[1:len(all_)], lambda x: length(x))) AS len,
                generate_subscripts(all_, 1) AS pos FROM tok)),
occ AS (SELECT t, CAST(f - length(value) AS BIGINT) AS s, CAST(f AS BIGINT) AS f FROM run JOIN told ON told.term = run.value),
span AS (SELECT t, kind, rank, s, f FROM e JOIN kinds USING (kind)
         UNION ALL SELECT t, 'term', 5, s, f FROM occ
         WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.t = occ.t AND e.s < occ.f AND e.f > occ.s)),
g AS (SELECT t, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
             count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
             count(*) FILTER (kind = 'term') AS n_term,
             string_agg(kind || ':' || s || ':' || f, ',' ORDER BY s, rank) FILTER (kind <> 'term') AS base,
             string_agg(kind || ':' || s || ':' || f, ',' ORDER BY s, rank) AS spans FROM span GROUP BY t)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, coalesce(n_term, 0) AS n_term,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (t)
"""
