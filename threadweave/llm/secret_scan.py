"""Operator 7 - secret scan with a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived: a
formula of AND / OR over three-byte strings which every match must contain.
Texts are indexed block by block: a block (a slice of a task's texts) gets
postings - sorted text numbers per trigram - for the trigrams that some query
names.  Intersecting and uniting postings gives a rule's candidates, and the
rule's expression is run on those alone.  A rule without mandatory trigrams
(a plain character class) is run on every text.  Index and queries are on
lower-cased ASCII letters, which can only add candidates.

No shuffle: a block's postings answer for that block, so the index never
outgrows a task, and a lost executor costs the blocks it held.

Defined results: a null or empty text has no spans; repeated rows give
repeated, equal result rows; a null ``doc_id`` is passed through; spans that begin
at one place are in the order of their kinds; a very long text is a slice by
itself; an empty table gives no rows; other columns are kept by ``mask_secrets`` and ignored by
``scan_secrets``.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadweave.llm.shipping import ship
from threadweave.llm.textcols import id_text, slices

try:  # the parser's place in the standard library
    from re import _constants as C
    from re import _parser as parser
except ImportError:  # Python before 3.11
    import sre_constants as C
    import sre_parse as parser

EXACT_LIMIT = 64


@dataclass(frozen=True)
class Rule:
    """``pattern``; if ``group`` is set, matches whose group is shorter than
    ``min_len`` code points are dropped (they still take up their text)."""

    kind: str
    pattern: str
    group: int = 0
    min_len: int = 0
    base: bool = False


def either_case(word: str) -> str:
    """A pattern for the word with ASCII letters in either case (not the
    Unicode folds that re.IGNORECASE adds)."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in word)


_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))

RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, base=True),
    Rule("hex", r"[0-9a-f]+", 0, 24, base=True),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)

# ---------------------------------------------------------------------------
# Boolean trigram queries: True (no condition), ("and"|"or", frozenset), or a trigram


def _all(*parts):
    parts = {p for p in parts if p is not True}
    flat = frozenset(x for p in parts for x in (p[1] if isinstance(p, tuple) and p[0] == "and" else [p]))
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", flat)


def _any(*parts):
    if any(p is True for p in parts):
        return True
    flat = frozenset(x for p in parts for x in (p[1] if isinstance(p, tuple) and p[0] == "or" else [p]))
    return next(iter(flat)) if len(flat) == 1 else ("or", flat)


def _of_strings(strings: frozenset[str]):
    """Every match contains one of these strings."""
    grams = []
    for s in strings:
        raw = s.encode()
        grams.append(_all(*(raw[i:i + 3] for i in range(len(raw) - 2))))
    return _any(*grams) if grams else True


@dataclass(frozen=True)
class _Part:
    """What is known of an expression's matches: all possible strings
    (``exact``), or else a condition that holds for each (``query``)."""

    exact: frozenset[str] | None = None
    query: object = field(default=True)

    def condition(self):
        return _all(self.query, _of_strings(self.exact)) if self.exact is not None else self.query


def _one_of(items) -> _Part:
    chars: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL:
            chars.add(chr(arg).lower() if arg < 128 else chr(arg))
        elif op is C.RANGE and arg[1] - arg[0] < EXACT_LIMIT:
            chars |= {chr(x).lower() if x < 128 else chr(x) for x in range(arg[0], arg[1] + 1)}
        else:
            return _Part()
    return _Part(frozenset(chars)) if len(chars) <= EXACT_LIMIT // 4 else _Part()


def _sequence(parts: list[_Part]) -> _Part:
    """Concatenation: runs of exact parts are multiplied out; a run that grows
    too large, or meets an inexact part, is turned into its condition."""
    query, run, whole = True, frozenset([""]), True
    for p in parts:
        if p.exact is not None and len(run) * len(p.exact) <= EXACT_LIMIT:
            run = frozenset(a + b for a, b in product(run, p.exact))
            query = _all(query, p.query)
            continue
        query, whole = _all(query, _of_strings(run), p.condition() if p.exact is None else True), False
        run = p.exact if p.exact is not None else frozenset([""])
        query = _all(query, p.query)
    return _Part(run, query) if whole else _Part(None, _all(query, _of_strings(run)))


def _part(node) -> _Part:
    op, arg = node
    if op is C.LITERAL:
        return _one_of([node])
    if op is C.IN:
        return _one_of(arg)
    if op is C.SUBPATTERN:
        return _sequence([_part(x) for x in arg[3]])
    if op is C.BRANCH:
        parts = [_sequence([_part(x) for x in branch]) for branch in arg[1]]
        if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= EXACT_LIMIT:
            return _Part(frozenset().union(*(p.exact for p in parts)), _any(*(p.query for p in parts)))
        return _Part(None, _any(*(p.condition() for p in parts)))
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, body = arg
        inner = _sequence([_part(x) for x in body])
        if low == 0:
            return _Part(inner.exact | {""}) if high == 1 and inner.exact is not None and inner.query is True else _Part()
        if low == high == 1:
            return inner
        return _Part(None, inner.condition())
    if op is C.AT:
        return _Part(frozenset([""]))
    return _Part()


def trigram_query(pattern: str):
    """The Boolean trigram query of an expression; True if nothing is mandatory."""
    return _sequence([_part(x) for x in parser.parse(pattern)]).condition()


def _grams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_grams, query[1]))


class TrigramIndex:
    """Postings of one block: for each indexed trigram, the texts that hold it."""

    def __init__(self, data: np.ndarray, owner_end: np.ndarray, slot: np.ndarray, n_grams: int):
        low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * 32
        self.n = len(owner_end)
        if len(low) < 3:
            self.postings = [np.zeros(0, np.int64)] * n_grams
            return
        code = (low[:-2].astype(np.uint32) << 16) | (low[1:-1].astype(np.uint32) << 8) | low[2:]
        got = slot[code]
        at = np.flatnonzero(got)
        text = np.searchsorted(owner_end, at, side="right")
        inside = at + 3 <= owner_end[text]
        pairs = np.unique((got[at][inside].astype(np.int64) - 1) * self.n + text[inside])
        cut = np.searchsorted(pairs, np.arange(n_grams + 1) * self.n)
        self.postings = [pairs[cut[i]:cut[i + 1]] - i * self.n for i in range(n_grams)]

    def candidates(self, query, number: dict[bytes, int]) -> np.ndarray:
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[number[query]]
        found = [self.candidates(q, number) for q in query[1]]
        if query[0] == "and":
            return reduce(np.intersect1d, sorted(found, key=len))
        return reduce(np.union1d, found)


def _finder(rules: tuple[Rule, ...]):
    """A function from a slice's texts to spans (text, start, end, kind) in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    number = {g: i for i, g in enumerate(sorted(set().union(*map(_grams, queries))))}
    slot = np.zeros(1 << 24, np.uint16)
    for g, i in number.items():
        slot[int.from_bytes(g, "big")] = i + 1
    compiled = [re.compile(r.pattern) for r in rules]

    def find(texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        strings = texts.to_pylist()
        raw = texts.cast(pa.binary()).to_pylist()
        end = np.cumsum([len(x) for x in raw], dtype=np.int64)
        index = TrigramIndex(np.frombuffer(b"".join(raw), np.uint8), end, slot, len(number))
        spans: list[list[tuple[int, int, int]]] = [[] for _ in strings]
        for k, rule in enumerate(rules):
            for i in index.candidates(queries[k], number).tolist():
                for m in compiled[k].finditer(strings[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.min_len:
                        spans[i].append((m.start(), k, m.end()))
        for s in spans:
            s.sort()
        return spans

    return find


SCHEMA = """doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long,
    found array<struct<kind: string, start: long, end: long>>"""


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base
    spans, all spans as text and as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, names = _finder(rules), [r.kind for r in rules]
        base = {k for k, r in enumerate(rules) if r.base}
        found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(batches):
            spans = find(part["text"])
            text = [[(k, f"{names[k]}:{a}:{b}") for a, k, b in row] for row in spans]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"],
                **{f"n_{kind}": pa.array([sum(names[k] == kind for _, k, _ in row) for row in spans], pa.int64())
                   for kind in ("assign", "access", "hex")},
                "base_sha256": [hashlib.sha256(",".join(x for k, x in row if k in base).encode()).hexdigest() for row in text],
                "spans": [",".join(x for _, x in row) for row in text],
                "n_added": pa.array([sum(k not in base for _, k, _ in row) for row in spans], pa.int64()),
                "found": pa.array([[{"kind": names[k], "start": a, "end": b} for a, k, b in row] for row in spans], found_type),
            })

    return id_text(docs).mapInArrow(run, SCHEMA)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "<secret>") -> DataFrame:
    """The same rows and columns with each span of ``text`` (overlapping ones
    united) replaced by ``mask``; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(rules)
        for part in slices(batches):
            at = part.schema.get_field_index("text")
            out = []
            for s, row in zip(part["text"].to_pylist(), find(part["text"].fill_null("")), strict=True):
                if not row:
                    out.append(s)
                    continue
                pieces, done = [], 0
                for a, _, b in row:
                    if a >= done:
                        pieces += [s[done:a], mask]
                    done = max(done, b)
                out.append("".join([*pieces, s[done:]]))
            yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)

