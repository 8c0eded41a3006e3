"""Finding and marking windows that occur more than once in a corpus.

Shared by the two operators that remove repeated text.  A *window* is
``width`` consecutive symbols (bytes or words) of one document.  Its *anchor*
is its k-gram with the smallest hash (the first of equal ones), so equal
windows have equal anchors at equal offsets.  Neighbouring windows with the
same anchor form a *string*: one occurrence of a k-gram with all windows that
it anchors.

1. Anchors of all documents are counted by hash; those seen once drop out with
   all their windows.
2. Documents give the strings of their remaining anchors: an occurrence row
   (digest, document, place) each, and one row per distinct string and task
   with its text, number of occurrences and smallest document id.
3. The strings of an anchor meet in one task, where an operator marks their
   windows.  An anchor with more than ``hot`` distinct strings is not gathered:
   its windows are counted by their 128-bit digests, combined before the shuffle.
4. Marks go back to the occurrences and, by document, to the texts.

Only anchors, the strings of repeated anchors and (twice) texts are shuffled.
Counts and joins on anchors, digests and documents combine before the shuffle
or leave hot keys to AQE's skew splitting.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadweave.llm.tables import Workspace, small
from threadweave.llm.textcols import MIX, id_text, mix, slices, word_hashes, words

KEY = ["id0", "row"]
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Windows:
    """Symbols, window width and anchor length; strings of an anchor that one
    task may gather; bytes of strings that a task combines before it emits them."""

    unit: str  # "byte" or "word"
    width: int
    gram: int
    hot: int = 50_000
    combine_bytes: int = 32 << 20

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Symbol hashes of the texts end to end, and where each begins."""
        if self.unit == "word":
            w = words(texts)
            return word_hashes(w.vocab)[w.codes] if len(w.codes) else np.zeros(0, np.uint64), w.starts
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
        return mix(np.arange(1, 257, dtype=np.uint64) * MIX)[data], np.concatenate([[0], np.cumsum(size)])

    def split(self, raw: bytes):
        return raw.split() if self.unit == "word" else raw

    def join(self, part) -> bytes:
        return b" ".join(part) if self.unit == "word" else part


def gram_hashes(sym: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols from each position on (shorter by k - 1)."""
    power, width, out, done = sym, 1, None, 0
    while True:
        if k & width:
            if out is None:
                out, done = power, width
            else:
                n = len(sym) - done - width + 1
                out, done = _join(out[:max(n, 0)], power[done:done + max(n, 0)]), done + width
        width *= 2
        if width > k:
            return out
        n = max(len(sym) - width + 1, 0)
        power = _join(power[:n], power[width // 2:width // 2 + n])


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0xBF58476D1CE4E5B9) + b
    x ^= x >> np.uint64(32)
    return x * MIX


def anchors(sym: np.ndarray, starts: np.ndarray, width: int, gram: int) -> dict[str, np.ndarray]:
    """Strings of the texts: text number, anchor hash, and - from the text's
    start - the first window's place, the number of windows, and the anchor's
    offset from the first window."""
    none = {c: np.zeros(0, np.int64) for c in ("text", "h", "p0", "n_win", "off")}
    if len(sym) < width:
        return none
    h = gram_hashes(sym, gram)
    bits = np.uint64(max(16, int(len(h)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # ties go to the first
    span, reach = width - gram + 1, 1
    while 2 * reach <= span:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < span:
        best = np.minimum(best[:len(best) - (span - reach)], best[span - reach:])
    size = np.diff(starts)
    room = np.maximum(size - width + 1, 0)
    text = np.repeat(np.arange(len(size)), room)
    p = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room)
    if not len(p):
        return none
    at = (best[starts[:-1][text] + p] & low).astype(np.int64)
    new = np.ones(len(p), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return {"text": text[first], "h": h[at[first]].view(np.int64), "p0": p[first],
            "n_win": np.diff(np.concatenate([first, [len(p)]])), "off": at[first] - starts[:-1][text[first]] - p[first]}


def ids_differ(docs: DataFrame) -> bool:
    """Whether every row has an id of its own."""
    return not id_text(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()


def keyed(docs: DataFrame, by_id: bool) -> DataFrame:
    """doc_id, text and the row's key: its id and - unless ids alone tell rows
    apart - a hash of its text."""
    return id_text(docs).withColumns({"id0": F.coalesce("doc_id", F.lit(NO_ID)),
                                      "row": F.lit(0).cast("long") if by_id else F.xxhash64("text")})


def _scan(docs: DataFrame, w: Windows) -> DataFrame:
    """(h, key, pos) of each anchor; ``pos`` packs first window, windows and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = anchors(*w.symbols(part["text"]), w.width, w.gram)
            text = pa.array(found["text"])
            pos = found["p0"] << 20 | found["n_win"] << 10 | found["off"]
            yield pa.RecordBatch.from_arrays([pa.array(found["h"], pa.int64()), part["id0"].take(text), part["row"].take(text), pa.array(pos, pa.int64())],
                                             ["h", "id0", "row", "pos"])

    if w.width >= 1 << 10:
        raise ValueError("windows of 1024 symbols or more don't fit a packed place")
    return docs.select("text", *KEY).mapInArrow(run, "h long, id0 long, row long, pos long")


STRINGS = "g long, s1 long, s2 long, id0 long, row long, p0 int, n_win int, off int, body binary, n long, least long"


def _strings(docs: DataFrame, lists: DataFrame, w: Windows) -> DataFrame:
    """Occurrence rows (body null) and combined string rows of the documents in ``lists``."""
    schema = pa.schema([("g", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("id0", pa.int64()), ("row", pa.int64()),
                        ("p0", pa.int32()), ("n_win", pa.int32()), ("off", pa.int32()), ("body", pa.binary()), ("n", pa.int64()),
                        ("least", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], list] = {}
        held = 0

        def combined() -> Iterator[pa.RecordBatch]:
            rows = list(seen.items())
            for i in range(0, len(rows), 10_000):
                part = rows[i:i + 10_000]
                k = len(part)
                empty = {c: pa.nulls(k, schema.field(c).type) for c in ("id0", "row", "p0")}
                yield pa.RecordBatch.from_pydict(empty | {
                    "s1": [x[0] for x, _ in part], "s2": [x[1] for x, _ in part],
                    **{c: [v[j] for _, v in part] for j, c in enumerate(("g", "n_win", "off", "body", "n", "least"))}}, schema=schema)

        for part in slices(batches):
            out: dict[str, list] = {c: [] for c in ("g", "s1", "s2", "id0", "row", "p0")}
            items, cut = part["items"].flatten(), part["items"].offsets.to_numpy()
            hashes, places = items.field("h").to_numpy().tolist(), items.field("pos").to_numpy().tolist()
            cut = (cut - cut[0]).tolist()
            for raw, id0, row, i, j in zip(part["text"].cast(pa.binary()).to_pylist(), part["id0"].to_pylist(), part["row"].to_pylist(),
                                           cut[:-1], cut[1:], strict=True):
                symbols = w.split(raw)
                for g, pos in zip(hashes[i:j], places[i:j], strict=True):
                    p0, n_win, off = pos >> 20, pos >> 10 & 1023, pos & 1023
                    body = w.join(symbols[p0:p0 + n_win + w.width - 1])
                    digest = xxhash.xxh3_128_digest(body, (g + off) & 0xFFFFFFFF)
                    sid = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
                    got = seen.get(sid)
                    if got is None:
                        seen[sid] = [g, n_win, off, body, 1, None if id0 == NO_ID else id0]
                        held += len(body) + 200
                    else:
                        got[4] += 1
                        if id0 != NO_ID and (got[5] is None or id0 < got[5]):
                            got[5] = id0
                    for c, v in zip(out, (g, *sid, id0, row, p0), strict=True):
                        out[c].append(v)
            k = len(out["g"])
            empty = {c: pa.nulls(k, schema.field(c).type) for c in ("n_win", "off", "body", "n", "least")}
            yield pa.RecordBatch.from_pydict(out | empty, schema=schema)
            if held > w.combine_bytes:
                yield from combined()
                seen.clear()
                held = 0
        yield from combined()

    return docs.join(lists, KEY).select("text", *KEY, "items").mapInArrow(run, STRINGS)


class Strings:
    """The distinct strings of whole anchors in a task, as columns."""

    def __init__(self, rows: list[list]):
        self.g, self.n_win, self.off, self.body, self.n, self.least = (list(x) for x in zip(*rows, strict=True))


def gathered(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[list[tuple[int, int]], Strings]]:
    """Rows sorted by anchor, combined by digest, in chunks of whole anchors of
    about ``chunk`` strings."""
    rows: dict[tuple[int, int], list] = {}
    group = None
    for b in batches:
        for g, s1, s2, n_win, off, body, n, least in zip(*(b[c].to_pylist() for c in ("g", "s1", "s2", "n_win", "off", "body", "n", "least")),
                                                         strict=True):
            if g != group:
                if len(rows) >= chunk:
                    yield list(rows), Strings(list(rows.values()))
                    rows = {}
                group = g
            got = rows.get((s1, s2))
            if got is None:
                rows[s1, s2] = [g, n_win, off, body, n, least]
            else:
                got[4] += n
                if least is not None and (got[5] is None or least < got[5]):
                    got[5] = least
    if rows:
        yield list(rows), Strings(list(rows.values()))


Solver = Callable[[Strings], "list[bytes | None]"]


def _solve(strings: DataFrame, solve: Solver, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sids, own in gathered(batches, chunk):
            marks = [(a, b, m) for (a, b), m in zip(sids, solve(own), strict=True) if m is not None]
            if marks:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in marks], pa.int64()), pa.array([x[1] for x in marks], pa.int64()),
                                                  pa.array([x[2] for x in marks], pa.binary())], ["s1", "s2", "marks"])

    return strings.repartition("g").sortWithinPartitions("g").mapInArrow(run, "s1 long, s2 long, marks binary")


Packer = Callable[["list[int]", "list[int | None]"], bytes]


def _by_window(strings: DataFrame, w: Windows, pack: Packer) -> DataFrame:
    """Marks of the strings of hot anchors: each window counted by its digest."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for s1, s2, n_win, body, n, least in zip(*(b[c].to_pylist() for c in ("s1", "s2", "n_win", "body", "n", "least")), strict=True):
                symbols = w.split(body)
                for j in range(n_win):
                    d = xxhash.xxh3_128_digest(w.join(symbols[j:j + w.width]))
                    out.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), s1, s2, j, n, least))
            cols = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.int64()], strict=True)],
                                             ["w1", "w2", "s1", "s2", "j", "n", "least"])

    rows = strings.mapInArrow(explode, "w1 long, w2 long, s1 long, s2 long, j int, n long, least long")
    total = rows.groupBy("w1", "w2").agg(F.sum("n").alias("total"), F.min("least").alias("lowest"))
    back = (rows.select("w1", "w2", "s1", "s2", "j").distinct().join(total, ["w1", "w2"]).groupBy("s1", "s2")
            .agg(F.sort_array(F.collect_list(F.struct("j", "total", "lowest"))).alias("x")))

    def marks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [pack([y["total"] for y in x], [y["lowest"] for y in x]) for x in b["x"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["s1"], b["s2"], pa.array(marks, pa.binary())], ["s1", "s2", "marks"])

    return back.mapInArrow(marks_of, "s1 long, s2 long, marks binary")


def marked(docs: DataFrame, w: Windows, work: Workspace, repeated: Column, solve: Solver, pack: Packer,
           chunk: int = 20_000) -> DataFrame:
    """``docs``: keyed rows.  Per key: ``spans``, an array of (p0, marks), the marks of the
    windows from p0 on.  ``repeated``: condition on an anchor's columns ``n``
    (occurrences), ``lo`` and ``hi`` (ids).  ``solve`` gives marks for strings
    that meet in a task, ``pack`` for a hot anchor's string from its windows'
    occurrences and smallest ids."""
    found, _ = work.write(_scan(docs, w), "anchors")
    shared, n_shared = work.write(found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id0").alias("lo"), F.max("id0").alias("hi"))
                                  .filter(repeated).select("h"), "shared")
    work.settle()
    lists, _ = work.write(found.join(small(shared, n_shared), "h", "left_semi").groupBy(*KEY)
                          .agg(F.collect_list(F.struct("h", "pos")).alias("items")), "lists")
    work.drop("anchors", "shared")
    work.settle()
    both, _ = work.write(_strings(docs, lists, w), "strings")
    work.drop("lists")
    work.settle()
    strings = both.filter("body IS NOT NULL").select("g", "s1", "s2", "n_win", "off", "body", "n", "least")
    hot, n_hot = work.write(strings.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > w.hot).select("g"), "hot")
    parts = _solve(strings.join(small(hot, n_hot), "g", "left_anti") if n_hot else strings, solve, chunk)
    if n_hot:  # at most strings / hot keys
        parts = parts.unionByName(_by_window(strings.join(small(hot, n_hot), "g", "left_semi"), w, pack))
    marks, n_marks = work.write(parts, "marks")
    del parts, strings  # a plan that is still referred to keeps its shuffles
    work.settle()
    places = both.filter("body IS NULL").select("s1", "s2", *KEY, "p0")
    spans, _ = work.write(places.join(small(marks, n_marks, 100_000), ["s1", "s2"]).groupBy(*KEY)
                          .agg(F.collect_list(F.struct("p0", "marks")).alias("spans")), "spans")
    work.drop("strings", "marks", "hot")
    work.settle()
    return spans
