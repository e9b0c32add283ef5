"""Secret scan by assignment-aware lexing.

Three fixed patterns find what looks like a secret anywhere (`assign`, `access`, `hex`). On top of them the text is
read as source code or configuration: name-literal pairs are parsed, constants are propagated through names and
concatenations, and a literal is scored by the names it ends up under (`literal`). Pairs are assignments and entries,
the first argument of a call, command-line options, the value behind an authorisation scheme, and the text of an element.

A name stands for its last definition before it, or else for its first one behind. An expression goes on over a line end
behind a `+` or a backslash, inside a bracket that it began with, and to a string that is indented deeper than the line it
began on; it never takes a string that is itself a name.

Null or empty text: no span. Texts are read whole; every step is linear in the text. Repeated rows give repeated
results. Other columns pass through; a column named like the result is replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from .common import sparing

# The kinds in their order, and the base patterns with the shortest accepted length.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

# How much a word of a name speaks for a secret, or against one.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "apikey": 1.0,
    "token": 0.8, "credential": 0.8, "credentials": 0.8, "auth": 0.5, "bearer": 0.5, "private": 0.4,
    "key": 0.4, "api": 0.3, "access": 0.3, "signing": 0.3, "encryption": 0.3, "salt": 0.5,
    "name": -0.6, "id": -0.4, "url": -0.6, "path": -0.8, "file": -0.8, "type": -0.8, "length": -1.0,
    "count": -1.0, "limit": -1.0, "max": -1.0, "min": -1.0, "header": -0.6, "field": -0.8, "hint": -0.8,
    "policy": -0.8, "public": -0.8, "expiry": -0.8, "label": -0.8,
}
PLACEHOLDERS = frozenset(
    ("changeme", "password", "passwd", "example", "secret", "token", "default", "undefined", "required", "string")
)
SCORE = 0.5
# Bits of a full score, the characters a value's beginning is judged by, and a count that makes any other character full.
FULL_BITS, HEAD, ENOUGH = 24, 12, 1 << 25

_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_PAIR = re.compile(
    r"""(?<![A-Za-z0-9_$.-])(?P<quote>["']?)(?P<name>[A-Za-z_][A-Za-z0-9_$.-]*+)(?P=quote)(?:[ \t]*\])?[ \t]*"""
    r"""(?::=|=>|=(?!=)|:[ \t]*[A-Za-z_][A-Za-z0-9_.]*+[ \t]*=(?!=)|:(?!:))[ \t]*"""
)
_STRING = re.compile(
    r"[rbuRBU]{0,2}(?:\"\"\"(?P<a>(?:[^\\]|\\[\s\S])*?)\"\"\"|'''(?P<b>(?:[^\\]|\\[\s\S])*?)'''"
    r"|\"(?P<c>(?:[^\"\\\n]|\\.)*)\"|'(?P<d>(?:[^'\\\n]|\\.)*)')"
)
_BARE = re.compile(r"""[^\s,;'"`(){}\[\]<>]+""")
_CLASSES = [re.compile(c) for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9\\s]")]
_CONSTANT = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
_JOIN = re.compile(r"[ \t]*+(?:\\\n[ \t]*+)?(?P<plus>\+)?[ \t]*+(?P<end>(?P<back>\\)?\n[\s]*+)?")
_NEXT_PLUS = re.compile(r"\+[ \t]*+")
_IS_NAME = re.compile(r"[ \t]*+\]?[ \t]*+(?::(?!:)|=(?![=>])|=>)")
_BRACKET = re.compile(r"\(\s*+")
_INDENT = re.compile(r"[ \t]*+")
_CALL = re.compile(r"""(?<![A-Za-z0-9_$])(?P<name>[A-Za-z_][A-Za-z0-9_]*+)\([ \t]*+(?=[rbuRBU]{0,2}["'])""")
_OPTION = re.compile(r"(?<![A-Za-z0-9_$.-])--?(?P<name>[A-Za-z][A-Za-z0-9_-]*+)(?:=|[ \t]++(?!-))")
_SCHEME = re.compile(r"(?<![A-Za-z0-9_])(?:[Bb]earer|[Bb]asic|[Tt]oken)[ \t]++(?P<value>[A-Za-z0-9+/_.=~-]{16,}+)")
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)(?:[ \t][^<>]*+)?>\s*+(?P<value>[^<>\s](?:[^<>]*[^<>\s])?)\s*+</(?P=name)>")
# Calls that hand a secret out or look at it say nothing of their argument.
GETTERS = frozenset(("get", "fetch", "read", "load", "find", "lookup", "check", "has", "is", "env", "getenv", "require", "print", "log"))


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def name_score(name: str) -> float:
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    joined = {a + b for a, b in zip(words, words[1:])}
    return min(1.0, sum(NAME_WEIGHTS.get(w, 0.0) for w in words) + sum(0.5 for w in joined if w in NAME_WEIGHTS))


class Value(NamedTuple):
    """What the score of a literal needs of it; pieces joined have the joined value's."""

    length: int  # counted up to ENOUGH
    head: str
    counts: dict[str, int] | None  # None from FULL_BITS on
    classes: frozenset[int]
    spaced: bool
    quoted: bool


def _bits(counts: dict[str, int]) -> float:
    n = sum(counts.values())
    return -sum(c * math.log2(c / n) for c in counts.values())


def _value(text: str, start: int, end: int, quoted: bool) -> Value:
    """Read as far as more characters can change a score: pieces may lie within each other."""
    value, at, size = Value(0, "", {}, frozenset(), False, quoted), start, 64
    while at < end and (value.counts is not None or len(value.classes) < 2):
        part = text[at : min(at + size, end)]
        classes = frozenset(i for i, c in enumerate(_CLASSES) if c.search(part))
        value = _together(value, _held(len(part), part[:HEAD], Counter(part), classes, " " in part, quoted))
        at, size = at + size, 2 * size
    return value._replace(length=min(end - start, ENOUGH))


def _held(length, head, counts, classes, spaced, quoted) -> Value:
    """Pieces only add bits, so counts end with them; before, all is one letter but for a few and counts to ENOUGH."""
    if counts is not None:
        counts = None if _bits(counts) >= FULL_BITS else {k: min(c, ENOUGH) for k, c in counts.items()}
    return Value(min(length, ENOUGH), head, counts, classes, spaced, quoted)


def _together(a: Value, b: Value) -> Value:
    counts = None
    if a.counts is not None and b.counts is not None:
        counts = {k: a.counts.get(k, 0) + b.counts.get(k, 0) for k in a.counts | b.counts}
    return _held(
        a.length + b.length, (a.head + b.head)[:HEAD], counts, a.classes | b.classes, a.spaced or b.spaced,
        a.quoted or b.quoted,
    )


NOTHING = Value(0, "", {}, frozenset(), False, False)
# Characters of a passphrase, words in one letter case.
PHRASE = 20


def literal_score(value: Value) -> float:
    """0 for what can't be a secret, rising to 1 with the bits that the characters carry; half of that for a passphrase."""
    if value.length < 6 or value.head[0] in "$<{%" or "://" in value.head:
        return 0.0
    if value.length <= HEAD and value.head.lower() in PLACEHOLDERS:
        return 0.0
    phrase = value.quoted and value.spaced and value.length >= PHRASE
    if len(value.classes) < 2 and not phrase and not (value.quoted and value.length >= 12 and not value.spaced):
        return 0.0
    bits = 1.0 if value.counts is None else min(1.0, _bits(value.counts) / FULL_BITS)
    return bits / 2 if phrase and len(value.classes) < 2 else bits


def base_spans(text: str) -> list[Span]:
    spans = []
    lower = text.lower()
    if any(stem in lower for stem in ASSIGN_STEMS):
        spans += [Span("assign", *m.span(), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    spans += [Span("access", *m.span(), 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    spans += [Span("hex", *m.span(), 1.0) for m in HEX.finditer(text)]
    return spans


class _Lexer:
    """The expressions of a text as nodes: a piece of the text, and the nodes joined to it behind.

    A constant is held, not copied, so names that double each other and long chains of names stay linear. A name that is not
    known yet is a node of its own and holds its definition once that is met. Neighbouring strings are one chain from each of
    their places, read once for each indentation.
    """

    def __init__(self, text: str):
        self.text = text
        self.nodes: list[list] = []  # piece, held nodes, quoted
        self.chains: dict[tuple, tuple[int | None, int | None]] = {}
        self.run = (0, 0)
        self.line = self.seen = 0
        self.constants: dict[str, int] = {}
        self.waiting: dict[str, list[int]] = {}

    def node(self, piece, held, quoted=False) -> int:
        self.nodes.append([piece, held, quoted])
        return len(self.nodes) - 1

    def define(self, name: str, node: int) -> None:
        if name not in self.constants:
            for early in self.waiting.pop(name, ()):
                self.nodes[early][:2] = None, (node,)
        self.constants[name] = node

    def indent(self, at: int) -> int:
        """The indentation of the line that a place is on; places come in the order of the text."""
        self.line = max(self.line, self.text.rfind("\n", self.seen, at) + 1)
        self.seen = at
        return _INDENT.match(self.text, self.line).end() - self.line

    def follows(self, at: int, deeper: int | None) -> int | None:
        """The place of the next term behind one that ends here; `deeper` is the indentation to pass, or None in a bracket."""
        glue = _JOIN.match(self.text, at)
        place = glue.end()
        if glue["plus"]:
            return place
        if glue["end"] and not glue["back"]:
            shift = len(glue[0]) - (glue[0].rfind("\n") + 1)
            if deeper is not None and shift <= deeper:
                return None
            if plus := _NEXT_PLUS.match(self.text, place):
                return plus.end()
        m = _STRING.match(self.text, place)
        return place if m and not _IS_NAME.match(self.text, m.end()) else None

    def strings(self, at: int, deeper: int | None) -> tuple[int | None, int | None] | None:
        """The strings joined from a place on, and the place of a term behind them that is none."""
        read, place = [], at
        while place is not None and (place, deeper) not in self.chains and (m := _STRING.match(self.text, place)):
            read.append((place, m.span(m.lastgroup)))
            place = self.follows(m.end(), deeper)
        known, after = self.chains.get((place, deeper), (None, place))
        for start, piece in reversed(read):
            known = self.node(piece, () if known is None else (known,), True)
            self.chains[start, deeper] = known, after
        return self.chains.get((at, deeper))

    def bare(self, at: int) -> int | None:
        """The end of the bare word at a place. Words may be pairs again, as in a:b:c, so the last end is held."""
        if not self.run[0] <= at < self.run[1]:
            m = _BARE.match(self.text, at)
            if not m:
                return None
            self.run = m.span()
        return self.run[1]

    def expression(self, at: int | None, began: int) -> int | None:
        """The node of the expression at a place, behind a name at `began`."""
        deeper, held, alone = self.indent(began), [], None
        if self.text.startswith("(", at):
            deeper, at = None, _BRACKET.match(self.text, at).end()
        while at is not None:
            if chain := self.strings(at, deeper):
                held.append(chain[0])
                at = chain[1]
            elif end := self.bare(at):
                m = _CONSTANT.match(self.text, at)
                if not m or m.end() < end:
                    if not held:
                        return self.node((at, end), ())
                    break
                if m[0] in self.constants:
                    held.append(self.constants[m[0]])
                else:
                    alone = self.node((at, end), ())
                    self.waiting.setdefault(m[0], []).append(alone)
                    held.append(alone)
                at = self.follows(end, deeper)
            else:
                break
        if len(held) < 2:
            return held[0] if held else None
        return self.node(None, tuple(held))

    def settle(self, lone: set[int]) -> None:
        """Names that were never defined are bare words where they stand alone, and nothing among other terms."""
        for nodes in self.waiting.values():
            for i in nodes:
                if i not in lone:
                    self.nodes[i][0] = None

    def order(self, wanted: set[int]) -> tuple[list[int], dict[int, list[int]]]:
        """The wanted nodes and all that they hold, each behind those it holds, and what each holds but for circles."""
        state: dict[int, int] = {}
        done: list[int] = []
        held: dict[int, list[int]] = {}
        for root in sorted(wanted):
            stack = [(root, 0)] if root not in state else []
            while stack:
                i, k = stack.pop()
                if k == 0:
                    state[i], held[i] = 1, []
                rest = self.nodes[i][1]
                while k < len(rest) and state.get(rest[k]) is not None:
                    if state[rest[k]] == 2:
                        held[i].append(rest[k])
                    k += 1
                if k < len(rest):
                    held[i].append(rest[k])
                    stack += [(i, k + 1), (rest[k], 0)]
                else:
                    state[i] = 2
                    done.append(i)
        return done, held

    def values(self, order: list[int], holds: dict[int, list[int]]) -> dict[int, Value]:
        found: dict[int, Value] = {}
        for i in order:
            piece, _, quoted = self.nodes[i]
            parts = [found[j] for j in holds[i]]
            if piece:
                parts.insert(0, _value(self.text, *piece, quoted))
            found[i] = reduce(_together, parts) if parts else NOTHING
        return found


def _pairs(text: str) -> Iterator[tuple[int, int, str, float, bool]]:
    """(begin, place of the value, name, score, whether it defines the name) in the order of the text."""
    found = [(m.start(), m.end(), m["name"], name_score(m["name"]), True) for m in _PAIR.finditer(text)]
    for m in _CALL.finditer(text) if "(" in text else ():
        if not GETTERS & {w.lower() for w in _NAME_WORD.findall(m["name"])}:
            found.append((m.start(), m.end(), m["name"], name_score(m["name"]), False))
    if "-" in text:
        found += [(m.start(), m.end(), m["name"], name_score(m["name"]), False) for m in _OPTION.finditer(text)]
    return iter(sorted(found))


def literal_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly or through constants."""
    lexer, sensitive, lone = _Lexer(text), {}, set()
    for begin, at, name, score, defines in _pairs(text):
        if not defines and score <= 0:
            continue
        node = lexer.expression(at, begin)
        if node is None:
            continue
        lone.add(node)
        if defines:
            lexer.define(name, node)
        if score > 0:
            sensitive[node] = max(score, sensitive.get(node, 0.0))
    lexer.settle(lone)
    schemes = _SCHEME.finditer(text) if any(w in text for w in ("earer", "asic", "oken")) else ()
    for m in (*schemes, *(_ELEMENT.finditer(text) if "</" in text else ())):
        score = name_score(m["name"]) if "name" in m.re.groupindex else 1.0
        if score > 0:
            sensitive[lexer.node(m.span("value"), (), "name" in m.re.groupindex)] = score
    if not sensitive:
        return []
    order, holds = lexer.order(set(sensitive))
    values = lexer.values(order, holds)
    reached = {i: score for i, s in sensitive.items() if (score := s * literal_score(values[i])) >= SCORE}
    found: dict[tuple[int, int], float] = {}
    for i in reversed(order):
        if i in reached:
            piece = lexer.nodes[i][0]
            if piece and piece[0] < piece[1]:
                found[piece] = max(reached[i], found.get(piece, 0.0))
            for j in holds[i]:
                reached[j] = max(reached[i], reached.get(j, 0.0))
    return [Span("literal", *piece, score) for piece, score in found.items()]


def _merged(found: list[Span]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s in sorted(found, key=lambda s: s.start):
        if merged and s.start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], s.end))
        else:
            merged.append((s.start, s.end))
    return merged


def spans(text: str | None) -> list[Span]:
    """All spans by start, then kind. A literal inside a base span is that span's and not repeated."""
    if not text:
        return []
    base = base_spans(text)
    covered = _merged(base)
    starts = [c[0] for c in covered]
    added = []
    for s in literal_spans(text):
        at = bisect_right(starts, s.start) - 1
        if at < 0 or s.end > covered[at][1]:
            added.append(s)
    return sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redacted(text: str | None, mask: str) -> str | None:
    """The text with every span, overlapping ones as one, replaced by the mask."""
    found = spans(text)
    if not found:
        return text
    out, at = [], 0
    for start, end in _merged(found):
        out += [text[at:start], mask]
        at = end
    return "".join(out) + text[at:]


_SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_secrets(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns and `secrets`, the spans of the whole text (code points, end exclusive)."""
    keep = [c for c in keep if c != "secrets"]
    source = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = source.drop("__text").schema
    result = StructType(schema.fields + [StructField("secrets", _spans_type())])
    arrow = to_arrow_schema(result)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in spans(t)] for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(found, arrow.field(len(keep)).type)], schema=arrow
            )

    return source.mapInArrow(sparing(scan), result)


def _spans_type():
    return StructType.fromDDL(f"x {_SPAN_TYPE}")["x"].dataType


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents with their secrets masked; all columns in their order."""
    at = docs.columns.index(text_col)
    schema = StructType(
        [StructField(f.name, StringType(), True) if f.name == text_col else f for f in docs.schema.fields]
    )
    arrow = to_arrow_schema(schema)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.cast(arrow.field(i).type) for i, c in enumerate(batch.columns)]
            columns[at] = pa.array([redacted(t, mask) for t in batch.column(at).to_pylist()], arrow.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(sparing(clean), schema)


def joined(spans_col: Column) -> Column:
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the hash of the base spans and the text form of all spans."""
    base = F.filter("secrets", lambda s: s["kind"] != "literal")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        id_col,
        *(count(k) for k in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
