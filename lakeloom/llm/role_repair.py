"""Conversation structure repair: generalised LR parsing with weighted edits.

Rows of a conversation are repaired to role initials of the language
``(s?(ua)+)?`` at least cost: keep (0), rerole to user or assistant (2), delete
(3, required for blank and duplicate rows), insert an empty user or assistant
row (2); a truncated row that stays adds 1. Among cheapest repairs the one whose
audit, the initials ``K R D I`` of its edits in order, is least in ASCII wins.

The parser reads a conversation from its last row to its first, so its grammar
is ``C: empty | T | T s; T: a u | T a u``. Its graph-structured stack has one
vertex for each LR state a row can end in: every edit of a row is an action on
every stack top (a kept row shifts its initial, a reroled or inserted one its
new role, a deletion leaves the top), shifts are followed by the reductions that
are due, and equal tops merge by the smaller (cost, audit). Reading backwards
makes that merge exact: an edit goes in *front* of the audits that are compared,
so their order never changes later (appending could turn it round where one is
the beginning of the other). Audits are compared by their rank among the tops of
a row, so a row costs the same however long the conversation is.

Two passes over one shuffle, both streams in the order of a sort: the first,
from the last row, writes beside each row the edges of its vertices; the second,
after a sort inside the same partitions, follows them from the first row and
feeds the digest. A task holds one row, the few stack tops and, for the result,
one audit letter per row; a hot conversation's rows pass one task (its digest
is sequential) but are never held together. Which rows repeat earlier ones is
settled before, by aggregations and a join whose keys include turn and text.

Definitions. A fault is judged on the rows by turn (nulls first; rows of one turn
by role and text): blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text
seen earlier), truncated (the last such character is not ``.``, ``!`` or ``?``);
the first that holds counts. A null role or text is one space, a null conv_id is
one conversation. Repeated rows are duplicates of each other. Other columns are
not looked at. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import prepare
from lakeloom.llm.fim import _batches, _rows, _schema

DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
#: Faults of a row.
WHOLE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3
_ROLE = {"u": "user", "a": "assistant"}

#: LR table of the grammar above: shifts, reductions (symbols popped, symbol
#: pushed), gotos, and the states in which the input may end.
_SHIFT = {(0, "a"): 1, (1, "u"): 2, (3, "a"): 4, (4, "u"): 5, (3, "s"): 6}
_REDUCE = {2: (2, "T"), 5: (3, "T")}
_GOTO = {(0, "T"): 3}
_ENDS = (0, 3, 6)


def _push(stack: tuple[int, ...], symbol: str) -> tuple[int, ...] | None:
    """Shift a symbol, then reduce as long as a rule is complete."""
    state = _SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack += (state,)
    while stack[-1] in _REDUCE:
        popped, symbol = _REDUCE[stack[-1]]
        stack = stack[:-popped]
        stack += (_GOTO[stack[-1], symbol],)
    return stack


def _tops() -> dict[int, dict[str, int]]:
    """Stack tops by top and symbol. Every top lies on one stack only (the rule
    is left-recursive), so equal tops are equal stacks."""
    found, seen = {}, [(0,)]
    for stack in seen:
        moves = {x: s for x in "usa" if (s := _push(stack, x))}
        found[stack[-1]] = {x: s[-1] for x, s in moves.items()}
        seen += [s for s in moves.values() if s not in seen]
    return found


_NEXT = _tops()


class Stack:
    """The stack's tops after some rows, read from the last: for each state its
    cost, the rank of its audit, and the edge it came by."""

    def __init__(self):
        self.cost: dict[int, int] = {}
        self.rank: dict[int, int] = {}
        self.edges = self._layer({0: (0, (), ("", "", 0))})

    def _layer(self, tops: dict[int, tuple]) -> str:
        """Add insertions, rank the audits, and write the edges as text: four
        characters (state, edit, symbol, state below) for each top."""
        again = True
        while again:
            again = False
            for q, (cost, audit, _) in list(tops.items()):
                for x in _ROLE:
                    to = _NEXT[q].get(x)
                    new = (cost + INSERT, ("I", audit))
                    if to is not None and (to not in tops or new < tops[to][:2]):
                        tops[to], again = (*new, ("I", x, q)), True
        place = {a: k for k, a in enumerate(sorted({t[1] for t in tops.values()}))}
        self.cost = {q: t[0] for q, t in tops.items()}
        self.rank = {q: place[t[1]] for q, t in tops.items()}
        return "".join(f"{q}{e or '.'}{x or '.'}{below}" for q, (_, _, (e, x, below)) in tops.items())

    def read(self, initial: str, fault: int) -> str:
        """Read one more row in front; returns the edges of its tops."""
        tops: dict[int, tuple] = {}

        def offer(to: int | None, cost: int, edit: str, symbol: str, below: int) -> None:
            if to is not None:
                new = (self.cost[below] + cost, (edit, self.rank[below]))
                if to not in tops or new < tops[to][:2]:
                    tops[to] = (*new, (edit, symbol, below))

        for q in self.cost:
            offer(q, DELETE, "D", "", q)
            if fault in (WHOLE, TRUNCATED):
                late = CUT_OFF if fault == TRUNCATED else 0
                offer(_NEXT[q].get(initial), late, "K", "", q)
                for x in _ROLE:
                    offer(_NEXT[q].get(x), REROLE + late, "R", x, q)
        return self._layer(tops)

    def best(self) -> tuple[int, int]:
        """State and cost of the cheapest end."""
        q = min((q for q in _ENDS if q in self.cost), key=lambda q: (self.cost[q], self.rank[q]))
        return q, self.cost[q]


_LAST = Stack().edges


def _inserted(edges: dict[str, tuple], top: str) -> Iterator[tuple[str, str]]:
    """Insertions at this place, as ``(symbol, state below)``."""
    while edges[top][0] == "I":
        _, x, top = edges[top]
        yield x, top


def _edges(text: str) -> dict[str, tuple]:
    return {text[k]: (text[k + 1], text[k + 2], text[k + 3]) for k in range(0, len(text), 4)}


_LAST_EDGES = _edges(_LAST)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage to be repaired, by the crc32 of ``conv_id:turn`` modulo 20:
    0 drops a row (``copies`` 0), 1 empties its text, 2 removes its ``.!?``, 3
    repeats it (``copies`` 2), 4 makes it a user's."""
    def own(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", own("role").alias("role"), own("text").alias("text"),
                                (F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn")).cast("binary")) % 20).alias("by"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("by") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("by") == 0, 0).when(F.col("by") == 3, 2).otherwise(1).cast("long").alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """One row for each row of ``conv_id, turn, role, text, copies``, with its
    fault; a conversation without rows keeps one row of ``copy`` 0. Keys are
    free of nulls: ``c, cn`` the conversation, ``tn, t`` the turn."""
    gone = F.col("copies") == 0
    keyed = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("c"), F.col("conv_id").isNull().alias("cn"),
        (F.col("turn").isNotNull() & ~gone).alias("tn"),
        F.when(gone | F.col("turn").isNull(), 0).otherwise(F.col("turn")).cast("long").alias("t"),
        F.when(gone, "").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce("text", F.lit(" "))).alias("text"), "copies")
    keyed = keyed.withColumns({"h": F.xxhash64("text"), "k": F.xxhash64(F.lit(1), "text"), "gone": gone})
    same = ["c", "cn", "tn", "t", "role", "h", "k", "gone"]
    folded = keyed.groupBy(*same).agg(F.any_value("text").alias("text"), F.sum("copies").alias("copies"))
    firsts = keyed.filter(~F.col("gone")).groupBy("c", "cn", "role", "h", "k") \
        .agg(F.min(F.struct("tn", "t")).alias("f")) \
        .select("c", "cn", "f.tn", "f.t", "role", "h", "k", F.lit(False).alias("gone"), F.lit(True).alias("first"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut_off = F.col("text").rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z")
    return folded.join(firsts, same, "left") \
        .withColumn("copy", F.explode(F.when(F.col("gone"), F.array(F.lit(0).cast("long")))
                                      .otherwise(F.sequence(F.lit(1).cast("long"), F.col("copies"))))) \
        .select("c", "cn", "tn", "t", "role", "text", "copy",
                F.when(blank, BLANK).when(F.col("first").isNull() | (F.col("copy") > 1), DUPLICATE)
                .when(cut_off, TRUNCATED).otherwise(WHOLE).alias("fault"))


_KEYS = "c long, cn boolean, tn boolean, t long, role string, text string, copy long, fault int"
_READ = _KEYS + ", edges string, top int, cost long"
DIGESTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
          "repaired_sha256 string"
REPAIRED = "conv_id long, place long, turn long, role string, text string, edit string"
_ORDER = ("tn", "t", "role", "text", "copy")


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([pa.field(f.name, pa.bool_()) if f.name in ("cn", "tn") else f
                      for f in _schema(ddl.replace("boolean", "long"))])


def _parsed(rows: DataFrame) -> DataFrame:
    """``judged`` rows with the edges of their stack tops, last row first."""
    schema = _arrow(_READ)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            key, stack = None, None
            for r in _rows(batches):
                if r[:2] != key:
                    key, stack = r[:2], Stack()
                if r[6]:
                    edges = stack.read(r[4][:1], r[7])
                    yield (*r, edges, *stack.best())
                else:
                    yield (*r, "", 0, 0)
        yield from _batches(out(), schema)

    down = [F.col(c).desc() for c in ("c", "cn", *_ORDER)]
    return rows.repartition("c", "cn").sortWithinPartitions(*down).mapInArrow(parse, _READ)


class _Walk:
    """Follows the edges of one conversation from its first row."""

    def __init__(self):
        self.top = None

    def row(self, role: str, text: str, edges: str, top: int) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` of what a row adds (role None: deleted)."""
        at = _edges(edges)
        if self.top is None:
            self.top = str(top)
        for x, below in _inserted(at, self.top):
            yield "I", _ROLE[x], ""
            self.top = below
        edit, x, self.top = at[self.top]
        yield edit, None if edit == "D" else _ROLE[x] if edit == "R" else role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        for x, _ in _inserted(_LAST_EDGES, self.top or "0"):
            yield "I", _ROLE[x], ""


def _digested(groups: Iterator[tuple]) -> Iterator[tuple]:
    key = None
    for r in groups:
        if r[:2] != key:
            if key is not None:
                yield done()
            key, walk, digest, audit, n = r[:2], _Walk(), hashlib.sha256(), bytearray(), 0
            faults, illegal, before, turns, low, high, cost = [0] * 4, 0, None, 0, None, None, 0

            def add(edits):
                nonlocal n
                for edit, role, text in edits:
                    audit.extend(edit.encode())
                    if role is not None:
                        digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
                        n += 1

            def done():
                add(walk.end())
                gaps = high - low + 1 - turns if turns else 0
                return (None if key[1] else key[0], gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal,
                        cost, audit.decode(), digest.hexdigest())
        _, _, tn, t, role, text, copy, fault, edges, top, total = r
        if not copy:
            continue
        if walk.top is None:
            cost = total
        faults[fault] += 1
        if tn and t != high:
            turns, low, high = turns + 1, t if low is None else low, t
        if before is not None and before + role[:1] not in ("su", "ua", "au"):
            illegal += 1
        before = role[:1]
        add(walk.row(role, text, edges, top))
    if key is not None:
        yield done()


def _repaired(groups: Iterator[tuple]) -> Iterator[tuple]:
    key = None
    for r in groups:
        if r[:2] != key:
            if key is not None:
                yield from placed(walk.end(), None)
            key, walk, n = r[:2], _Walk(), 0

            def placed(edits, turn):
                nonlocal n
                for edit, role, text in edits:
                    if role is not None:
                        yield None if key[1] else key[0], n, None if edit == "I" else turn, role, text, edit
                        n += 1
        _, _, tn, t, role, text, copy, _, edges, top, _ = r
        if copy:
            yield from placed(walk.row(role, text, edges, top), t if tn else None)
    if key is not None:
        yield from placed(walk.end(), None)


def _walked(rows: DataFrame, follow, ddl: str) -> DataFrame:
    schema = _schema(ddl)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(follow(_rows(batches)), schema)

    return _parsed(judged(rows)).sortWithinPartitions("c", "cn", *_ORDER).mapInArrow(walk, ddl)


def repair_digest(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conversation of ``conv_id, turn,
    role, text, copies`` (a row of 0 copies only names its conversation)."""
    prepare(rows.sparkSession)
    return _walked(rows, _digested, DIGESTS)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id, place, turn, role, text, edit`` (``K``,
    ``R`` or ``I``; inserted rows have no turn)."""
    prepare(rows.sparkSession)
    return _walked(rows.select("conv_id", "turn", "role", "text", F.lit(1).cast("long").alias("copies")), _repaired, REPAIRED)


# --- the same in SQL: a table over rows and tops instead of a stack --------------

def _sql() -> str:
    never = "CAST(1000000000 AS BIGINT)"

    def edit(below: str, cost: str, letter: str, line: str | None, allowed: str) -> str:
        rest = f"{below}.r" if line is None else f"CASE WHEN {below}.r = '' THEN {line} ELSE {line} || chr(10) || {below}.r END"
        return f"{{'c': CASE WHEN {allowed} THEN {below}.c + {cost} ELSE {never} END, 'a': '{letter}' || {below}.a, 'r': {rest}}}"

    def shifted(top: int, moves: list[tuple[int, str]]) -> str:
        found = [edit(f"s{top}", "3", "D", None, "true")]
        for below, x in moves:
            found.append(edit(f"s{below}", "late", "K", "role || ':' || text", f"fault < 2 AND x = '{x}'"))
            if x in _ROLE:
                found.append(edit(f"s{below}", "2 + late", "R", f"'{_ROLE[x]}:' || text", "fault < 2"))
        return f"list_min([{', '.join(found)}])"

    def inserted(below: str, x: str) -> str:
        return edit(below, "2", "I", f"'{_ROLE[x]}:'", "true")

    start = {0: (0, "", ""), 1: (2, "I", "assistant:"), 3: (4, "II", "user:\nassistant:"),
             4: (6, "III", "assistant:\nuser:\nassistant:"), 6: (1000000000, "", "")}
    first = ", ".join("{'c': CAST(%d AS BIGINT), 'a': '%s', 'r': '%s'} AS s%d" % (c, a, r, q) for q, (c, a, r) in start.items())
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY k) AS t FROM (
    SELECT k, list_reduce(list_prepend(CAST(k AS BIGINT), range(8)),
                          lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM range(256) r(k))),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT src.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                 list_transform(string_split(k, ''), lambda ch: CAST(ord(ch) AS BIGINT))),
                 lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS by_ FROM src, crc),
dam AS (SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS g, turn, CASE WHEN by_ = 4 THEN 'user' ELSE role END AS role,
               CASE by_ WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE by_ WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM hit),
num AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
flt AS (SELECT *, role[1:1] AS x, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 2
               WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 3
               WHEN regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z') THEN 1 ELSE 0 END AS fault FROM num),
rws AS (SELECT *, CASE WHEN fault = 1 THEN 1 ELSE 0 END AS late,
               lag(x) OVER (PARTITION BY g ORDER BY i) AS before_ FROM flt),
conv AS (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS g FROM conversations),
sums AS (SELECT g, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
                count(*) FILTER (fault = 1) AS truncated,
                count(*) FILTER (before_ IS NOT NULL AND before_ || x NOT IN ('su', 'ua', 'au')) AS illegal
         FROM rws GROUP BY g),
dp AS (
  SELECT g, n AS i, {first} FROM sums
  UNION ALL
  SELECT g, i, s0, s1, s3, list_min([s4, {inserted('s3', 'a')}]) AS s4, s6 FROM (
    SELECT g, i, s0, s1, list_min([s3, {inserted('s1', 'u')}, {inserted('s4', 'u')}]) AS s3, s4, s6 FROM (
      SELECT g, i, s0, list_min([s1, {inserted('s0', 'a')}]) AS s1, s3, s4, s6 FROM (
        SELECT dp.g, dp.i - 1 AS i, {edit('s0', '3', 'D', None, 'true')} AS s0, {shifted(1, [(0, 'a')])} AS s1,
               {shifted(3, [(1, 'u'), (4, 'u')])} AS s3, {shifted(4, [(3, 'a')])} AS s4, {shifted(6, [(3, 's')])} AS s6
        FROM dp JOIN rws ON rws.g = dp.g AND rws.i = dp.i)))),
fin AS (SELECT g, list_min([s0, s3, s6]) AS b FROM dp WHERE i = 0)
SELECT conv.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(b.r, '')) AS repaired_sha256
FROM conv LEFT JOIN sums USING (g) LEFT JOIN fin USING (g)
"""


REPAIR_SQL = _sql()
