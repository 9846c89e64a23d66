"""Chat formatting by compiled templates.

A small sandboxed template language is parsed into a syntax tree, constants
are folded, and the tree becomes Python closures. Rendering yields pieces of
text and says which of them lie inside ``{% generation %}``; those are the
spans a loss mask covers.

Language: text, ``{{ expr }}``, ``{% for x in list %}``, ``{% if %}`` /
``{% elif %}`` / ``{% else %}``, ``{% generation %}``, ``{% set x = expr %}``,
``{# comment #}``. Expressions: names, ``a.b`` or ``a['b']`` (keys of the given
values and fields of ``loop`` only), strings, integers, ``true``, ``false``,
``none``, ``==``, ``!=``, ``and``, ``or``, ``not``, ``+`` and ``~`` (texts),
brackets, and the filters escape, trim, upper, lower, length. There are no
calls, no attributes of Python objects and no way to import anything.

``escape`` is reversible: where a control string occurs in a text, with any
number of backslashes after its first character, one more backslash is put
there; :func:`unescape` takes one away.

Conversations: rows of one ``conv_id`` in order of turn (null first), then
role and text. Null role and text are empty, a null ``conv_id`` is one
conversation, repeated rows are repeated turns, extra columns are ignored and
an empty table gives no rows. A task streams through its rows in order and
writes a conversation in parts of whole turns, so the longest conversation
needs no more memory than its longest turn. A template that does more with
``messages`` than go through them once (an index, a length, a second or an inner
loop) is given one conversation's rows as a list.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import prepare

#: Strings that no text may bring into the output.
CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]")
TURNS = ("{% for m in messages %}<|turn|>{{ m.role | escape }}<|text|>"
         "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
         "{% else %}{{ m.text | escape }}{% endif %}<|end|>\n{% endfor %}")
#: Characters after which a conversation goes on in a new part.
PART_CHARS = 1 << 20


class TemplateError(ValueError):
    """The template is not in the language."""


# --- escaping ---------------------------------------------------------------

@functools.lru_cache(maxsize=8)
def _patterns(control: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    for a in control:
        if len(a) < 2 or "\\" in a:
            raise TemplateError("a control string has two characters or more and no backslash")
        for b in control:
            if any(b.startswith(a[i:]) or a[i:].startswith(b) for i in range(1, len(a))):
                raise TemplateError(f"control strings {a!r} and {b!r} overlap")
    some = "|".join(f"(?<={re.escape(c[0])})(?=\\\\*{re.escape(c[1:])})" for c in control)
    less = "|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in control)
    return re.compile(some), re.compile(less)


def escape(text: str, control: tuple[str, ...] = CONTROL) -> str:
    """``text`` without control strings; :func:`unescape` gives it back."""
    return _patterns(control)[0].sub(r"\\", text)


def unescape(text: str, control: tuple[str, ...] = CONTROL) -> str:
    return _patterns(control)[1].sub("", text)


# --- parsing ----------------------------------------------------------------
# A node is a tuple (kind, ...). Output nodes: text, out, for, if, gen, set.
# Expression nodes: const, name, key, eq, ne, and, or, not, add, filter.

_PARTS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)"
                    r"|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[|.+~()\[\]=]))")
_FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(), "length": lambda v: len(v)}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _text(v: Any) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return "true" if v else "false"
    return v if isinstance(v, str) else str(v)


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("", "")

    def take(self, value: str | None = None) -> str:
        kind, got = self.peek()
        if not kind or value is not None and got != value:
            raise TemplateError(f"expected {value or 'more'}, found {got!r}")
        self.at += 1
        return got

    def whole(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.peek() == ("name", "or"):
            self.take()
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.peek() == ("name", "and"):
            self.take()
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        if self.peek() == ("name", "not"):
            self.take()
            return ("not", self.negated())
        node = self.joined()
        while self.peek()[1] in ("==", "!=") and self.peek()[0] == "op":
            kind = "eq" if self.take() == "==" else "ne"
            node = (kind, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.peek() in (("op", "+"), ("op", "~")):
            self.take()
            node = ("add", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.peek() == ("op", "|"):
            self.take()
            name = self.take()
            if name != "escape" and name not in _FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        kind, got = self.peek()
        self.take()
        if kind == "str":
            node: tuple = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), got[1:-1], flags=re.S))
        elif kind == "int":
            node = ("const", int(got))
        elif kind == "name" and got in ("true", "false", "none"):
            node = ("const", {"true": True, "false": False, "none": None}[got])
        elif kind == "name" and got not in ("and", "or", "not", "in"):
            node = ("name", got)
        elif got == "(":
            node = self.either()
            self.take(")")
        else:
            raise TemplateError(f"unexpected {got!r}")
        while self.peek() in (("op", "."), ("op", "[")):
            if self.take() == ".":
                node = ("key", node, ("const", self.take()))
            else:
                node = ("key", node, self.either())
                self.take("]")
        return node


def parse(source: str) -> list[tuple]:
    """The template's syntax tree: a list of output nodes."""
    stack: list[tuple[str, list, Any]] = [("", [], None)]
    for part in _PARTS.split(source):
        body = stack[-1][1]
        if part.startswith("{{"):
            body.append(("out", _Expression(part[2:-2]).whole()))
        elif part.startswith("{#"):
            continue
        elif not part.startswith("{%"):
            if part:
                body.append(("text", part))
        else:
            word, _, rest = part[2:-2].strip().partition(" ")
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"for: {rest!r}")
                stack.append(("for", [], (m[1], _Expression(m[2]).whole())))
            elif word == "if":
                stack.append(("if", [], [(_Expression(rest).whole(), None)]))
            elif word in ("elif", "else"):
                kind, own, cases = stack.pop()
                if kind != "if" or cases[-1][0] == ("const", True) and cases[-1][1] is None and len(cases) > 1:
                    raise TemplateError(f"{word} outside if")
                cases[-1] = (cases[-1][0], own)
                cases.append((("const", True) if word == "else" else _Expression(rest).whole(), None))
                stack.append(("if", [], cases))
            elif word == "generation":
                stack.append(("gen", [], None))
            elif word == "set":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"set: {rest!r}")
                body.append(("set", m[1], _Expression(m[2]).whole()))
            elif word in ("endfor", "endif", "endgeneration"):
                kind, own, head = stack.pop()
                if {"endfor": "for", "endif": "if", "endgeneration": "gen"}[word] != kind:
                    raise TemplateError(f"{word} closes {kind or 'nothing'}")
                if kind == "for":
                    node: tuple = ("for", *head, own)
                elif kind == "gen":
                    node = ("gen", own)
                else:
                    head[-1] = (head[-1][0], own)
                    node = ("if", head)
                stack[-1][1].append(node)
            else:
                raise TemplateError(f"unknown tag {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return stack[0][1]


# --- folding ----------------------------------------------------------------

def fold_expr(node: tuple) -> tuple:
    """Evaluate what does not depend on the data."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    parts = [fold_expr(x) if isinstance(x, tuple) else x for x in node[1:]]
    folded = (kind, *parts)
    own = [x for x in parts if isinstance(x, tuple)]
    if kind != "key" and not (kind == "filter" and parts[0] == "escape") and all(x[0] == "const" for x in own):
        return ("const", _expr(folded, ())({}))
    if kind in ("and", "or") and own[0][0] == "const":
        decided = bool(own[0][1]) == (kind == "or")
        return own[0] if decided else own[1]
    return folded


def fold(nodes: list[tuple]) -> list[tuple]:
    """Fold expressions, drop dead branches, join neighbouring texts."""
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "out":
            e = fold_expr(node[1])
            new = [("text", _text(e[1]))] if e[0] == "const" else [("out", e)]
        elif kind == "set":
            new = [("set", node[1], fold_expr(node[2]))]
        elif kind == "for":
            new = [("for", node[1], fold_expr(node[2]), fold(node[3]))]
        elif kind == "gen":
            new = [("gen", fold(node[1]))]
        elif kind == "if":
            cases = []
            for cond, body in node[1]:
                cond = fold_expr(cond)
                if cond[0] == "const" and not cond[1]:
                    continue
                cases.append((cond, fold(body)))
                if cond[0] == "const":
                    break
            new = list(cases[0][1]) if cases and cases[0][0][0] == "const" else [("if", cases)] if cases else []
        else:
            new = [node]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


def names_used(nodes: Any, name: str) -> int:
    """How often a tree (or expression) uses a name."""
    if isinstance(nodes, tuple) and nodes[:1] == ("name",):
        return int(nodes[1] == name)
    if isinstance(nodes, tuple) and nodes[:1] in (("const",), ("text",)):
        return 0
    return sum(names_used(x, name) for x in nodes if isinstance(x, (tuple, list))) if isinstance(nodes, (tuple, list)) else 0


def reads_once(nodes: list[tuple], name: str) -> bool:
    """Whether a value is only gone through once, by one loop outside of loops,
    so that it may be a stream."""
    def loops(body: list[tuple]) -> int:
        n = 0
        for node in body:
            if node[0] == "for":
                n += node[2] == ("name", name)
            elif node[0] == "gen":
                n += loops(node[1])
            elif node[0] == "if":
                n += max(loops(own) for _, own in node[1])
        return n

    def most(body: list[tuple]) -> int:         # uses on one way through the branches
        n = 0
        for node in body:
            if node[0] == "if":
                n += sum(names_used(cond, name) for cond, _ in node[1]) + max(most(own) for _, own in node[1])
            elif node[0] == "gen":
                n += most(node[1])
            else:
                n += names_used(node, name)
        return n

    return most(nodes) == loops(nodes) <= 1


# --- closures ---------------------------------------------------------------

def _key(value: Any, key: Any) -> Any:
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple)) and isinstance(key, int) and 0 <= key < len(value):
        return value[key]
    return None


def _expr(node: tuple, control: tuple[str, ...]) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda ctx: value
    if kind == "name":
        name = node[1]
        return lambda ctx: ctx.get(name)
    if kind == "filter":
        inner = _expr(node[2], control)
        if node[1] == "escape":
            return lambda ctx: escape(_text(inner(ctx)), control)
        run = _FILTERS[node[1]]
        return lambda ctx: run(inner(ctx))
    if kind == "not":
        inner = _expr(node[1], control)
        return lambda ctx: not inner(ctx)
    a, b = _expr(node[1], control), _expr(node[2], control)
    return {"key": lambda ctx: _key(a(ctx), b(ctx)), "eq": lambda ctx: a(ctx) == b(ctx),
            "ne": lambda ctx: a(ctx) != b(ctx), "and": lambda ctx: a(ctx) and b(ctx),
            "or": lambda ctx: a(ctx) or b(ctx), "add": lambda ctx: _text(a(ctx)) + _text(b(ctx))}[kind]


#: Between two rounds of a loop the output may be cut.
_ROUND = ("", None)


def _block(nodes: list[tuple], control: tuple[str, ...], marked: bool) -> Callable[[dict], Iterator]:
    steps = [_node(n, control, marked) for n in nodes]

    def run(ctx: dict) -> Iterator:
        for step in steps:
            yield from step(ctx)
    return run


def _node(node: tuple, control: tuple[str, ...], marked: bool) -> Callable[[dict], Iterator]:
    kind = node[0]
    if kind == "text":
        piece = (node[1], marked)
        return lambda ctx: (piece,)
    if kind == "out":
        value = _expr(node[1], control)
        return lambda ctx: ((_text(value(ctx)), marked),)
    if kind == "gen":
        return _block(node[1], control, True)
    if kind == "set":
        name, value = node[1], _expr(node[2], control)

        def assign(ctx: dict) -> Iterator:
            ctx[name] = value(ctx)
            return iter(())
        return assign
    if kind == "if":
        cases = [(_expr(c, control), _block(b, control, marked)) for c, b in node[1]]

        def choose(ctx: dict) -> Iterator:
            for cond, body in cases:
                if cond(ctx):
                    yield from body(ctx)
                    return
        return choose
    name, items, body = node[1], _expr(node[2], control), _block(node[3], control, marked)

    def loop(ctx: dict) -> Iterator:
        values = items(ctx)
        if values is None or isinstance(values, (str, dict, int)):
            return
        scope, rounds = dict(ctx), iter(values)
        ahead = next(rounds, _ROUND)
        index = 0
        while ahead is not _ROUND:
            scope[name], ahead = ahead, next(rounds, _ROUND)
            scope["loop"] = {"index": index + 1, "index0": index, "first": index == 0,
                             "last": ahead is _ROUND}
            yield from body(scope)
            yield _ROUND
            index += 1
    return loop


class Template:
    """A compiled template."""

    def __init__(self, source: str, control: tuple[str, ...] = CONTROL):
        _patterns(tuple(control))
        self.tree = fold(parse(source))
        self._run = _block(self.tree, tuple(control), False)

    def pieces(self, **values: Any) -> Iterator[tuple[str, bool | None]]:
        """``(text, under the mask)``; a mask of None ends a loop's round."""
        return self._run(dict(values))

    def render(self, **values: Any) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and its mask's spans (code points, end exclusive)."""
        parts = list(self.parts(1 << 62, **values))
        return parts[0][0], parts[0][1]

    def parts(self, size: int, **values: Any) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Text and spans, cut between rounds of a loop after ``size``
        characters; at least one part."""
        text: list[str] = []
        spans: list[tuple[int, int]] = []
        at, sent, cut = 0, False, False
        for piece, marked in self.pieces(**values):
            if marked is None:
                cut = at >= size
                continue
            if cut:
                yield "".join(text), spans
                text, spans, at, sent, cut = [], [], 0, True, False
            if marked and piece:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + len(piece))
                else:
                    spans.append((at, at + len(piece)))
            text.append(piece)
            at += len(piece)
        if text or not sent:
            yield "".join(text), spans


# --- conversations ----------------------------------------------------------

FORMATTED = "conv_id long, part int, last boolean, formatted string, spans array<struct<start:int,stop:int>>"


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[Any, Iterator[dict]]]:
    """Rows of each run of equal keys, streamed."""
    rows = (r for b in batches for r in b.to_pylist())
    state: dict[str, Any] = {"row": next(rows, None)}

    def run(value: Any) -> Iterator[dict]:
        while state["row"] is not None and state["row"][key] == value:
            row, state["row"] = state["row"], next(rows, None)
            yield row

    while state["row"] is not None:
        value = state["row"][key]
        own = run(value)
        yield value, own
        for _ in own:           # whatever the caller left
            pass


def format_conversations(rows: DataFrame, template: str = TURNS, control: tuple[str, ...] = CONTROL,
                         part_chars: int = PART_CHARS) -> DataFrame:
    """One row per part of a formatted conversation: ``conv_id, part, last,
    formatted, spans`` (spans count from the part's start)."""
    prepare(rows.sparkSession)
    Template(template, control)                 # a faulty template fails here
    once = reads_once(fold(parse(template)), "messages")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, control)
        held: list[dict] = []
        size = 0
        for conv, turns in _grouped(batches, "conv_id"):
            if not once:
                turns = list(turns)
            ahead, part = None, 0
            for text, spans in compiled.parts(part_chars, messages=turns):
                if ahead is not None:
                    held.append(ahead)
                ahead = {"conv_id": conv, "part": part, "last": False, "formatted": text,
                         "spans": [{"start": a, "stop": b} for a, b in spans]}
                part, size = part + 1, size + len(text)
                if size >= 4 * part_chars or len(held) >= 1000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
            held.append(ahead | {"last": True})
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()),
                        ("formatted", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text") \
        .mapInArrow(render, FORMATTED)


_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(formatted: DataFrame, control: tuple[str, ...] = CONTROL) -> DataFrame:
    """Turns and masked text of conversations formatted with ``TURNS``, as
    counts and digests. Conversations of one part are read where they lie;
    only the parts of longer ones are brought together, in order."""
    prepare(formatted.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for conv, parts in _grouped(((b) for b in batches), "conv_id"):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            for row in parts:
                text, at = row["formatted"], 0
                for m in _TURN.finditer(text):
                    if m.start() != at:
                        raise ValueError(f"conversation {conv}: text between turns")
                    at, n = m.end(), n + 1
                    for x in (m[1], m[2]):
                        turns.update(unescape(x, control).encode())
                        turns.update(b"\n")
                if at != len(text):
                    raise ValueError(f"conversation {conv}: text after the last turn")
                for s in row["spans"]:
                    own = unescape(text[s["start"]:s["stop"]], control)
                    loss.update(own.encode())
                    loss_chars += len(own)
                chars += len(text)
            held.append({"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(),
                         "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
            if len(held) >= 1000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64())])
    alone = formatted.filter("part = 0 and last").mapInArrow(digest, DIGESTS)
    longer = formatted.filter("not (part = 0 and last)").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "part").mapInArrow(digest, DIGESTS)
    return alone.union(longer)
