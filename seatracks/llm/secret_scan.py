"""Secret scans by assignment-aware lexing.

A text is read as source or configuration: name-literal pairs (``name = "x"``, ``name: x``, ``name => 'x'``, ``--name x``,
``<name>x</name>``, ``export NAME=x``), with literals joined by ``+`` and names that stand for earlier literals. A literal
is scored by its target name and its own looks. Three plain patterns (the base) are reported besides, as they are.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 32 or more are the runs that pass the length test.
HEX = re.compile(r"[0-9a-f]{32,}")

#: What a sensitive name holds, and how much each counts.
NAME_PARTS = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 2, "secret": 3, "token": 2, "apikey": 3, "accesskey": 3, "privatekey": 3, "signingkey": 3, "credential": 2, "credentials": 2, "auth": 1, "bearer": 2}
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")
#: Names that speak about secrets without holding one.
NAME_NOT = {"length", "len", "count", "policy", "url", "uri", "path", "file", "type", "name", "id", "field", "hint", "expiry", "ttl"}
PLACEHOLDER = re.compile(r"(?:change|replace)_?me|example|placeholder|your[_-]|dummy|sample|^x{3,}$|^\*+$|^<.*>$|^\$\{|^(?:null|none|true|false|undefined|nil)$", re.IGNORECASE)
#: Of these, the words that may stand anywhere.
WORDS = re.compile(PLACEHOLDER.pattern.partition("|^")[0], re.IGNORECASE)
LEAST_SCORE = 5.0

QUOTED = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"""
#: A name of any length, parted by points and single hyphens; it begins where a run of such characters does, and gives
#: nothing back, so a long run is read once.
NAME = r"(?<![\w.])(?<![\w.]-)\$?[A-Za-z_][\w.]*+(?:-[\w.]++)*+"
PAIR = re.compile(
    rf"""(?:["'\[]?(?P<name>{NAME})["'\]]{{0,2}}[ \t]*(?:=>|->|:=|=(?![=>])|:(?!:))[ \t]*(?P<value>{QUOTED}|[^\s"'`,;(){{}}<>\[\]]+)"""
    rf"""|(?<![\w-])--(?P<flag>[A-Za-z][\w-]*+)[ \t]+(?P<arg>{QUOTED}|[^\s"'`-][^\s"'`]*)"""
    r"""|<(?P<tag>[A-Za-z_][\w.-]*+)>(?P<body>[^<>\n]+)</)""",
    re.ASCII,
)
MORE = re.compile(rf"""[ \t]*(?:\+|\.\.?)[ \t]*(?P<value>{QUOTED}|\$?[A-Za-z_][\w.]*+)""", re.ASCII)
IDENT = re.compile(r"\$?\{?([A-Za-z_][\w.]*+)\}?", re.ASCII)
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", re.ASCII)


def name_score(name: str) -> float:
    """How sensitive a target name is: its camel-case and separated parts, alone and in pairs."""
    parts = [p.lower() for p in PARTS.findall(name)]
    if parts and parts[-1] in NAME_NOT:
        return 0.0
    return float(max([NAME_PARTS.get(p, 0) for p in parts] + [NAME_PARTS.get(a + b, 0) for a, b in zip(parts, parts[1:], strict=False)] + [0]))


def _score(n: float, entropy: float, classes: int) -> float:
    return min(n, 24) / 12 + classes / 2 + max(0.0, entropy - 2)


def _classes(x: Iterable[str]) -> set[int]:
    """Which classes of characters occur: digits, lower and upper case, others."""
    return {k for c in x for k, is_ in enumerate((c.isdigit(), c.islower(), c.isupper(), not c.isalnum())) if is_}


def literal_score(x: str) -> float:
    """How much a literal looks like a secret: length, character classes and entropy; placeholders score nothing."""
    if len(x) < 6 or PLACEHOLDER.search(x):
        return 0.0
    n, counts = len(x), Counter(x)
    return _score(n, -sum(c / n * math.log2(c / n) for c in counts.values()), len(_classes(counts)))


#: A joined literal up to this length is looked at as a text.
SHORT = 256
#: A placeholder's word, and what an anchored one begins with, are no longer.
EDGE = 16
#: Above this length, counts of characters are in units of it.
UNIT = 2.0**512


class _Looks:
    """What a joined literal's score needs, of all its characters: sums of sums can be of any length, so beyond ``SHORT``
    it is counts (in units, by the order in which characters were met), both ends, and whether a placeholder's word lies
    anywhere."""

    __slots__ = ("counts", "head", "kinds", "n", "placeholder", "tail", "text", "units")

    def __init__(self, parts: list[str | _Looks], order: dict[str, int]):
        looks = [p if isinstance(p, _Looks) else None for p in parts]
        self.text: str | None = None
        texts = [p if isinstance(p, str) else p.text for p in parts]
        if None not in texts and sum(map(len, texts)) <= SHORT:
            self.text = "".join(texts)
            return
        self.units = max((p.units for p in looks if p and p.text is None), default=0)
        self.counts, self.kinds, self.placeholder, self.head, self.tail = array("d"), set(), False, "", ""
        for p, text in zip(looks, texts, strict=True):
            if text is not None:
                seen = self.tail + text
                self.placeholder |= bool(WORDS.search(seen))
                self.kinds |= _classes(text)
                self._add(((order.setdefault(c, len(order)), k) for c, k in Counter(text).items()), self.units)
                head, self.tail = text, seen[-EDGE:]
            else:
                self.placeholder |= p.placeholder or bool(WORDS.search(self.tail + p.head))
                self.kinds |= p.kinds
                self._add(enumerate(p.counts), self.units - p.units)
                head, self.tail = p.head, p.tail
            self.head = (self.head + head[:EDGE])[:EDGE]
        self.n = sum(self.counts)
        if self.n > UNIT:
            self.counts, self.n, self.units = array("d", (k / UNIT for k in self.counts)), self.n / UNIT, self.units + 1

    def _add(self, counts: Iterable[tuple[int, float]], down: int) -> None:
        by = 1.0 if not down else 1 / UNIT if down == 1 else 0.0
        for i, k in counts:
            if i >= len(self.counts):
                self.counts.extend([0.0] * (i + 1 - len(self.counts)))
            self.counts[i] += k * by

    def score(self, order: dict[str, int]) -> float:
        """As ``literal_score`` of the whole text."""
        if self.text is not None:
            return literal_score(self.text)
        if self.placeholder or self.head.startswith("${") or self.head[0] == "<" and self.tail[-1] == ">":
            return 0.0
        only = {i for i, k in enumerate(self.counts) if k}
        if only <= {order.get("x"), order.get("X")} or only == {order.get("*")}:
            return 0.0
        return _score(math.inf, -sum(k / self.n * math.log2(k / self.n) for k in self.counts if k), len(self.kinds))


class _Value:
    """What a name stands for: its own span, or other values side by side. Names share values, so a value that holds
    another twice costs no more than a reference, and each span is found once."""

    __slots__ = ("found", "looks", "parts", "span")

    def __init__(self, looks: str | _Looks, span: tuple[int, int] | None, parts: list[_Value]):
        self.looks, self.span, self.parts, self.found = looks, span, parts, False

    def spans(self) -> Iterator[tuple[int, int]]:
        """The spans below that nothing has found yet."""
        todo = [self]
        while todo:
            value = todo.pop()
            if not value.found:
                value.found = True
                todo += reversed(value.parts)
                if value.span:
                    yield value.span


def lex(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that reach sensitive names, directly or through constants."""
    found: list[tuple[int, int]] = []
    bound: dict[str, _Value] = {}
    order: dict[str, int] = {}

    def literal(raw: str, at: int) -> list[_Value]:
        if raw[0] in "\"'`" and len(raw) >= 2:
            return [_Value(raw[1:-1], (at + 1, at + len(raw) - 1), [])]
        if (m := IDENT.fullmatch(raw)) and m[1] in bound:
            return [bound[m[1]]]
        raw = raw.rstrip(".,:!?")
        return [_Value(raw, (at, at + len(raw)), [])] if raw else []

    for m in PAIR.finditer(text):
        kind = "value" if m["value"] is not None else "arg" if m["arg"] is not None else "body"
        name = (m["name"] or m["flag"] or m["tag"]).lstrip("$")
        values, end = literal(m[kind], m.start(kind)), m.end()
        while kind == "value" and (more := MORE.match(text, end)):
            values += literal(more["value"], more.start("value"))
            end = more.end()
        value = bound[name] = values[0] if len(values) == 1 else _Value(_Looks([v.looks for v in values], order), None, values)
        weight = name_score(name)
        if weight and weight + (literal_score(value.looks) if isinstance(value.looks, str) else value.looks.score(order)) >= LEAST_SCORE:
            found += value.spans()
    return list(dict.fromkeys(found))


def spans(text: str) -> list[tuple[int, int, str, int]]:
    """All spans as (start, end, kind, start of the value), by start, then kind as listed. Ends are exclusive."""
    low = text.lower()
    out = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        out += [(m.start(), m.end(), 0, m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1, m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2, m.start()) for m in HEX.finditer(text)]
    if any(h in low for h in HINTS) and any(c in text for c in "=:<-"):
        out += [(a, b, 3, a) for a, b in lex(text)]
    return [(a, b, KINDS[k], v) for a, b, k, v in sorted(out, key=lambda s: (s[0], s[2], s[1]))]


def joined(found: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k, _ in found)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with each span's value replaced; overlapping spans by one mark."""
    out, at = [], 0
    for a, b in sorted((v, b) for _, b, _, v in spans(text)):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, base_spans string, spans string"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row for each document with its counts and spans in code points.

    Null or empty text: no spans. Repeated rows: one row each. Other columns are ignored; an empty table gives none.
    The memory of a task is one Arrow batch. A joined literal looks as its whole text does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column(1):
                found = spans(text.as_py() or "")
                n = Counter(k for _, _, k, _ in found)
                for c, x in zip(cols, (*[n[k] for k in KINDS], joined([s for s in found if s[2] != "lexed"]), joined(found)), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]], ["doc_id", "n_assign", "n_access", "n_hex", "n_lexed", "base_spans", "spans"])

    return common.id_text(docs).mapInArrow(common.tidy(run), SCHEMA)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns; ``text`` without its secrets, ``n_chars`` (if there) counted anew. Null and empty texts
    stay, repeated rows stay repeated, and an empty table gives none."""
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if (t := x.as_py()) is None else redacted(t) for x in batch.column(at)]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if chars is not None:
                cols[chars] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(common.tidy(run), docs.schema)
