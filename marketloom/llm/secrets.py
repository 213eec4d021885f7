"""Secrets in source, configuration and prose, by patterns and by assignment-aware lexing."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm import words

# The base kinds, in the order in which spans of one start are listed.
_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a maximal run, so the same as a run of any length, then 20 or more
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "lexed")

# A name, an operator, and the start of what is assigned; a type may stand between a colon and the equals sign of a quoted literal.
_TARGET = re.compile(
    r"""(?<![\w.$-])(?P<q>["']?)(?P<name>[A-Za-z_][\w.-]*)(?P=q)[ \t]*"""
    r"""(?::=|=>|=(?!=)|:[ \t]*[A-Za-z_][\w.]*(?:\[[\w., |]*\]|<[\w., |]*>)?\??[ \t]*=[ \t]*(?=[bBrRfFuU]{0,2}["'])|:(?![:/]))[ \t]*""",
    re.ASCII,
)
_PART = re.compile(
    r"""(?:[bBrRfFuU]{0,2}\"{3}(?P<tdq>(?:[^"\\]|\\[\s\S]|"(?!""))*)\"{3}|[bBrRfFuU]{0,2}'{3}(?P<tsq>(?:[^'\\]|\\[\s\S]|'(?!''))*)'{3}"""
    r"""|[bBrRfFuU]{0,2}"(?P<dq>(?:[^"\\\n]|\\.)*)"|[bBrRfFuU]{0,2}'(?P<sq>(?:[^'\\\n]|\\.)*)'|(?P<ref>\$\{?[A-Za-z_]\w*\}?)|(?P<bare>[A-Za-z0-9_+/.=~@!%^&*-]+))""",
    re.ASCII,
)
_JOIN = re.compile(r"[ \t]*[+.][ \t]*(?=[\"'$A-Za-z_])|[ \t]+(?=[\"'])", re.ASCII)
_PLACED = re.compile(r"\$\{([A-Za-z_]\w*)\}|\{([A-Za-z_]\w*)\}", re.ASCII)
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

# How telling a word of a target name is, alone and after a qualifying word.
_SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "authorization": 0.8}
_QUALIFIERS = {"api", "access", "private", "secret", "encryption", "signing", "auth", "master", "account", "storage", "client", "session", "shared", "license"}
_KEYLIKE = {"key", "pass", "auth", "sig", "signature", "salt", "cert", "dsn"}
_EMPTY_WORDS = re.compile(r"(?i)example|changeme|placeholder|dummy|sample|redacted|your[_-]")
_EMPTY_VALUES = {"none", "null", "true", "false", "undefined"}
_EDGE = 16  # characters of an end of a literal that are kept: more than any of those words has
_SURE = 0.9  # score of a last name word from which on a quoted literal of one kind of characters counts


def name_score(name: str) -> float:
    """0 to 1: how much a target of this name is expected to hold a secret."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    best = max((_SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    for before, p in zip(parts, parts[1:]):
        if p in _KEYLIKE and before in _QUALIFIERS:
            best = max(best, 0.95)
    return best


class Literal(NamedTuple):
    """What the score of a literal depends on; of joined literals, found without joining their characters."""

    length: int
    counts: dict[str, int]
    head: str  # all of it, if it is no longer
    tail: str
    empty: bool  # holds a word of ``_EMPTY_WORDS`` or <...>
    opens: bool  # holds <
    closes: bool  # holds >

    @classmethod
    def of(cls, text: str) -> Literal:
        opens, closes = text.find("<"), text.rfind(">")
        return cls(len(text), Counter(text), text[:_EDGE], text[-_EDGE:], bool(_EMPTY_WORDS.search(text)) or 0 <= opens < closes, opens >= 0, closes >= 0)

    def then(self, other: Literal) -> Literal:
        counts = dict(self.counts)
        for c, n in other.counts.items():
            counts[c] = counts.get(c, 0) + n
        between = bool(_EMPTY_WORDS.search(self.tail + other.head)) or self.opens and other.closes
        head = self.head if self.length >= _EDGE else (self.head + other.head)[:_EDGE]
        tail = other.tail if other.length >= _EDGE else (self.tail + other.tail)[-_EDGE:]
        return Literal(self.length + other.length, counts, head, tail, self.empty or other.empty or between, self.opens or other.opens, self.closes or other.closes)

    def usable(self) -> bool:
        """Long enough, without white space, and no placeholder."""
        spaced = any(c.isspace() for c in self.counts)
        return self.length >= 6 and not (spaced or self.empty or len(self.counts) == 1 or self.length <= _EDGE and self.head.lower() in _EMPTY_VALUES)

    def entropy(self) -> float:
        n = self.length
        return -sum(c / n * math.log2(c / n) for c in self.counts.values())

    def kinds(self) -> int:
        """Kinds of characters: lower, upper, digits, others."""
        return sum(any(map(f, self.counts)) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in self.counts)


def literal_score(value: str | Literal) -> float:
    """0 to 1: entropy and mixture of the characters; 0 for short values and placeholders."""
    value = Literal.of(value) if isinstance(value, str) else value
    if not value.usable():
        return 0.0
    kinds = value.kinds()
    return min(1.0, value.entropy() / 3.5) * min(1.0, 0.4 + 0.2 * kinds) * (1.0 if kinds > 1 else 0.6)


def pair_score(name: str, value: str | Literal, quoted: bool) -> float:
    """0 to 1: name score times literal score.

    If the last word of the name is a sensitive one by itself, a quoted
    literal of eight characters and more counts for its entropy alone, so
    that passwords of letters only are found.
    """
    sensitive = name_score(name)
    if not sensitive:
        return 0.0
    value = Literal.of(value) if isinstance(value, str) else value
    score = literal_score(value)
    last = _SENSITIVE.get(([p.lower() for p in _NAME_PARTS.findall(name)] or [""])[-1], 0.0)
    if quoted and last >= _SURE and value.length >= 8 and value.usable():
        score = max(score, 0.75 * min(1.0, value.entropy() / 2.5))
    return sensitive * score


class Assigned(NamedTuple):
    """A target, its value, the span of its literal, and whether all of it stands in quotes."""

    name: str
    value: str | Literal
    start: int
    end: int
    quoted: bool


def _joined(parts: list[str | Literal]) -> str | Literal:
    """One literal of all parts; a single text stays a text."""
    if len(parts) == 1:
        return parts[0]
    whole = Literal.of("")
    for x in parts:
        whole = whole.then(Literal.of(x) if isinstance(x, str) else x)
    return whole


def lex(text: str) -> Iterator[Assigned]:
    """Each assignment of literals, constants put in.

    A value is a chain of quoted literals (triple quotes among them), bare
    words and names joined by ``+``, ``.`` or juxtaposition. A name that was
    assigned before stands for its literal; the span is then that of the
    literal it came from, else from the first to the last literal of the
    chain. ``${NAME}`` and ``{NAME}`` inside quotes are replaced likewise.
    Joined values are kept as ``Literal``, whose size does not grow with them.
    """
    known: dict[str, Assigned] = {}
    for m in _TARGET.finditer(text):
        at, value, spans, quoted = m.end(), [], [], True
        while part := _PART.match(text, at):
            kind = part.lastgroup
            if kind in ("tdq", "tsq", "dq", "sq"):
                spans.append(part.span(kind))
                value += _filled(part[kind], known)
            else:
                word = part[kind].strip("${}") if kind == "ref" else part[kind]
                if word in known:
                    value.append(known[word].value)
                    spans.append((known[word].start, known[word].end))
                    quoted &= known[word].quoted
                elif kind == "bare" and not value:
                    value.append(word)
                    spans.append(part.span(kind))
                    quoted = False
                else:
                    break
            at = part.end()
            join = _JOIN.match(text, at)
            if not join or kind == "bare" and word not in known:
                break
            at = join.end()
        if spans:
            start, end = min(s for s, _ in spans), max(e for _, e in spans)
            if len({s < m.start() for s, _ in spans}) > 1:  # a constant and a literal here: the part here
                start = min(s for s, _ in spans if s >= m.start())
            known[m["name"]] = found = Assigned(m["name"], _joined(value), start, end, quoted)
            yield found


def _filled(text: str, known: dict[str, Assigned]) -> list[str | Literal]:
    """A quoted literal in parts, with known names in braces replaced."""
    parts, at = [], 0
    for x in _PLACED.finditer(text):
        if (name := x[1] or x[2]) in known:
            parts += [text[at : x.start()], known[name].value]
            at = x.end()
    return [*parts, text[at:]] if parts else [text]


def find(text: str | None, threshold: float) -> list[tuple[str, int, int, str, float]]:
    """(kind, start, end, target name, score) of one text, by start and kind."""
    if not text:
        return []
    found = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            found.append(("assign", *m.span(), m[1], 1.0))
    found += [("access", *m.span(), "", 1.0) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span(), "", 1.0) for m in _HEX.finditer(text)]
    if "=" in text or ":" in text:
        taken = sorted((s, e) for _, s, e, _, _ in found)
        # Sorted and with the furthest end so far, overlaps are found by bisection.
        starts, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        extra = set()
        for x in lex(text):
            score = pair_score(x.name, x.value, x.quoted)
            before = bisect_left(starts, x.end)  # base spans that begin before the end
            if score >= threshold and not (before and ends[before - 1] > x.start):
                extra.add(("lexed", x.start, x.end, x.name, round(score, 4)))
        found += extra
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2], x[3]))


SPANS = "array<struct<kind:string,start:int,end:int,name:string,score:double>>"
_SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())])
)


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``key`` and ``found``, the spans in code points, end exclusive.

    Base kinds ``assign``, ``access`` and ``hex`` come from fixed patterns.
    ``lexed`` spans are literals assigned to sensitive names (``lex``) with a
    ``pair_score`` of at least ``threshold``; those that
    overlap a base span are left out. Null and empty texts have no spans. No
    shuffle; rows are independent of each other, other columns are not read.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [dict(zip(("kind", "start", "end", "name", "score"), x)) for x in find(t.as_py(), threshold)]
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, _SPANS_ARROW)], ["key", "found"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(words.freed(scan), f"key {kind}, found {SPANS}").withColumnRenamed("key", key)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
