"""Fill-in-middle transformation by secondary-sort assembly.

A text of n code points is cut in a prefix, a middle and a suffix by numbers
taken from a digest of its doc_id, and written as ``psm``
(``<P>prefix<S>suffix<M>middle``) or ``spm`` (``<S>suffix<P>prefix<M>middle``).
Texts that are empty or hold one of the three marks, and a share of the others,
stay ``plain``.

No task assembles a document: texts leave the scan as pieces of at most
``UNIT`` code points keyed by document and position in the output. One shuffle
by document with a sort inside the partitions (``repartition`` and
``sortWithinPartitions``, the DataFrame form of
repartitionAndSortWithinPartitions) brings the pieces of a document in the
order of its output, and they stream through an incremental digest. The same
pass reads the output back: it finds the marks that the form names, in order,
and hands on what lies between them keyed by the place in the text. A second
sort inside the same partitions (no shuffle) restores the text, which streams
through a digest again. A task holds one piece and the bytes the sorts may
spill, whatever the length of a document.

The marks can be found again: a transformed text holds none of them, and a mark
that overlaps another one's edge would need a ``<`` inside a mark.

Every row is one document. Rows that repeat doc_id and text are folded where
they meet (within one input partition, so a hot one is spread over as many keys
as there are partitions) and returned as often as they occur. A null text is
empty, a null doc_id is digested as the empty string and returned as null.
Other columns are not looked at. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import prepare

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts left plain / of the others written suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20
#: Code points of one piece.
UNIT = 1 << 14
#: Parts of a text in its own order, by mark; marks in the order of a form.
_PART = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ()}
_META = 3                                    # sorts after a text's parts
_ROWS = 4096                                 # rows of an Arrow batch that is given back

_KEYS = "k1 long, k2 long"
_PIECES = f"{_KEYS}, pos long, piece string, doc_id long, form string, n long, prefix_chars long, middle_chars long"
_PARTS = f"{_KEYS}, part int, pos long, piece string, doc_id long, form string, n long, prefix_chars long, " \
         "middle_chars long, output_sha256 string, output string, copies long"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, " \
          "restored_sha256 string"


def cuts(doc_id: int | None, text: str) -> tuple[str, int | None, int | None]:
    """Form, end of the prefix and end of the middle (None if plain)."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or any(m in text for m in _PART) or h3 % 100 >= PLAIN_FROM:
        return "plain", None, None
    first, last = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return ("spm" if h4 % 100 < SPM_BELOW else "psm"), first, last


def _pieces(text: str, form: str, first: int | None, last: int | None, unit: int) -> Iterator[tuple[int, str]]:
    """Output position and text of each piece; a mark leads its part's first piece."""
    if form == "plain":
        parts = [("", 0, len(text))]
    else:
        span = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, len(text))}
        parts = [(m, *span[m]) for m in _ORDER[form]]
    pos = 0
    for mark, lo, hi in parts:
        for at in range(lo, max(hi, lo + 1), unit):
            piece = mark + text[at:min(at + unit, hi)]
            yield pos, piece
            pos += len(piece)
            mark = ""


class _Reader:
    """Splits a stream of output pieces at the marks of a form: yields
    ``(part, text)``."""

    def __init__(self, form: str):
        self.marks = list(_ORDER[form])
        self.part = 1 if not self.marks else -1
        self.held = ""

    def feed(self, piece: str) -> Iterator[tuple[int, str]]:
        buf = self.held + piece
        while self.marks:
            at = buf.find(self.marks[0])
            if at < 0:
                keep = max(0, len(buf) - len(self.marks[0]) + 1)
                if self.part >= 0 and keep:
                    yield self.part, buf[:keep]
                self.held = buf[keep:]
                return
            if self.part >= 0 and at:
                yield self.part, buf[:at]
            mark = self.marks.pop(0)
            self.part, buf = _PART[mark], buf[at + len(mark):]
        self.held = ""
        if buf:
            yield self.part, buf


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded rows and text."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= _ROWS or size > 1 << 21:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _schema(ddl: str) -> pa.Schema:
    kind = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(n, kind[t]) for n, t in (c.split() for c in ddl.split(", "))])


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: int = UNIT) -> DataFrame:
    """The pieces of all outputs: key, output position, text; the form and the
    cuts ride on the first piece of a document."""
    schema = _schema(_PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for k1, k2, i, t in _rows(batches):
                t = t or ""
                form, first, last = cuts(i, t)
                plain = form == "plain"
                meta = (i, form, len(t), first, None if plain else last - first)
                for pos, piece in _pieces(t, form, first, last, unit):
                    yield (k1, k2, pos, piece, *(meta if pos == 0 else (None,) * 5))
        yield from _batches(rows(), schema)

    own = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    part = F.spark_partition_id()
    return own.select(F.xxhash64(part, F.coalesce("_id", F.lit(-1).cast("long")), F.col("_id").isNull(), "_t").alias("k1"),
                      F.xxhash64("_t", "_id", part, F.lit(1)).alias("k2"), "_id", "_t").mapInArrow(cut, _PIECES)


def assemble(cut: DataFrame, outputs: bool = False) -> DataFrame:
    """``pieces`` to ``doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256``; with ``outputs`` the whole output as well
    (then a task holds one document)."""
    parts_schema, out_ddl = _schema(_PARTS), DIGESTS + (", output string" if outputs else "")
    out_schema = _schema(out_ddl)

    def read_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key = meta = None
            for k1, k2, pos, piece, *own in _rows(batches):
                if (k1, k2) != key:
                    if key:
                        yield (*key, _META, 0, None, *meta, digest.hexdigest(), "".join(whole) if outputs else None, copies)
                    key, meta, digest, reader, last, copies, whole = (k1, k2), own, hashlib.sha256(), _Reader(own[1]), -1, 0, []
                    places = [0, 0, 0]
                copies += pos == 0
                if pos == last:                  # a repeated row's piece
                    continue
                last = pos
                digest.update(piece.encode())
                if outputs:
                    whole.append(piece)
                for part, s in reader.feed(piece):
                    yield (*key, part, places[part], s, *(None,) * 8)
                    places[part] += len(s)
            if key:
                yield (*key, _META, 0, None, *meta, digest.hexdigest(), "".join(whole) if outputs else None, copies)
        yield from _batches(rows(), parts_schema)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            digest = hashlib.sha256()
            for _, _, part, _, piece, i, form, n, first, middle, out, output, copies in _rows(batches):
                if part != _META:
                    digest.update(piece.encode())
                    continue
                row = (i, n, form, first, middle, out, digest.hexdigest(), *([output] if outputs else []))
                digest = hashlib.sha256()
                for _ in range(copies):
                    yield row
        yield from _batches(rows(), out_schema)

    streamed = cut.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "pos").mapInArrow(read_outputs, _PARTS)
    return streamed.sortWithinPartitions("k1", "k2", "part", "pos").mapInArrow(restore, out_ddl)


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: int = UNIT,
                   outputs: bool = False) -> DataFrame:
    """Form, cuts and digests of every document's output and restored text
    (``outputs``: and the output itself)."""
    prepare(docs.sparkSession)
    return assemble(pieces(docs, doc_id, text, unit), outputs)


def restored_text(output: str, form: str) -> str:
    """The text of one output."""
    reader, parts = _Reader(form), ["", "", ""]
    for part, s in reader.feed(output):
        parts[part] += s
    return "".join(parts)


FIM_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                     THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM g),
p AS (SELECT *, t[1:a] AS pre, t[a + 1:b] AS mid, t[b + 1:] AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
