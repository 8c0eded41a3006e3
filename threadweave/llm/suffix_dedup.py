"""Operator 8 - repeated byte strings by merging Burrows-Wheeler transforms.

A byte is removed if a ``width``-byte string that covers it also starts
anywhere else in the corpus, same document included; strings are judged on
the input.  Texts are UTF-8 bytes and matches stay inside documents.

Suffixes are taken where they can matter: at the windows of repeated anchors
(see ``anchored``), whose strings are aligned at the anchor.  In a task the
strings are dealt to shards.  A shard's transform lists, for each column from
right to left, the byte before every suffix in the suffixes' sorted order; one
column follows from the next by a stable sort on that byte (an LF step).
Shards are merged without looking at suffixes again: the interleave of their
orders at a column is refined to the column before it by a stable sort of the
interleaved transform bytes, and the longest common prefixes of neighbours
follow from those of the column before: one more than the smallest value
between two suffixes with equal byte, zero otherwise.  A window is repeated
exactly if a neighbour in the merged order shares ``width`` bytes with it, or
its string occurs more than once.

Defined results: a null or empty text has no bytes; repeated rows are
documents of their own, so texts of ``width`` bytes or more lose everything; no
copy is kept, so there are no ties; a null ``doc_id`` is passed through; a very
long text is cut into anchored strings like any other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.llm.anchored import KEY, Strings, Windows, ids_differ, keyed, marked
from threadweave.llm.tables import Workspace
from threadweave.llm.textcols import covered, slices

OUTSIDE = 0xFF  # fills a string's columns outside its windows; no UTF-8 byte


def _lf_step(byte: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Stable order by (group, byte); ``group`` is sorted and below 65536."""
    by_byte = np.argsort(byte, kind="stable")
    return by_byte[np.argsort(group[by_byte], kind="stable")]


class ShardTransform:
    """The aligned strings of one shard: per column, the suffixes' order and
    the transform byte of the column before it."""

    def __init__(self, table: np.ndarray, group: np.ndarray):
        """``table``: columns x strings, strings sorted by ``group`` (uint16)."""
        columns, n = table.shape
        self.group = group
        self.order = np.empty((columns + 1, n), np.int32)
        self.byte = np.empty((columns, n), np.uint8)
        order = np.arange(n, dtype=np.int32)
        self.order[columns] = order
        for c in range(columns - 1, -1, -1):
            self.byte[c] = table[c][order]
            order = order[_lf_step(self.byte[c], group)]
            self.order[c] = order


def _prefixes(old: np.ndarray, step: np.ndarray, byte: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Common prefixes with the left neighbour after an LF step, from those before it."""
    out = np.zeros(len(old), np.int32)
    u, v = step[:-1], step[1:]
    same = np.flatnonzero((byte[u] == byte[v]) & (group[u] == group[v]))
    u, v = u[same], v[same]
    value = old[v]
    far = np.flatnonzero(v - u > 1)
    if len(far):
        edges = np.empty(2 * len(far), np.int64)
        edges[0::2], edges[1::2] = u[far] + 1, v[far] + 1
        closed = np.concatenate([old, [0]])  # an end at the last place needs an index
        value[far] = np.minimum.reduceat(closed, edges)[0::2]
    out[same + 1] = np.minimum(value + 1, limit)
    return out


def merge(shards: list[ShardTransform], limit: int):
    """Refine the interleave of the shards column by column.  Yields, from the
    last column to the first: column, the interleave (shard of each place), and
    the common prefix of each suffix with its left neighbour, up to ``limit``."""
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.group) for s in shards])
    group = np.concatenate([s.group for s in shards])
    start = np.argsort(group, kind="stable")
    source, group = source[start], group[start]  # every suffix is empty: groups side by side, shards in turn
    prefix = np.zeros(len(group), np.int32)
    for c in range(len(shards[0].byte) - 1, -1, -1):
        byte = np.empty(len(group), np.uint8)
        for k, s in enumerate(shards):
            byte[source == k] = s.byte[c]
        step = _lf_step(byte, group)
        prefix = _prefixes(prefix, step, byte, group, limit)
        source = source[step]
        yield c, source, prefix


def repeated_windows(own: Strings, width: int, shards: int = 2) -> np.ndarray:
    """Which windows (strings x offsets) of distinct aligned strings also occur in another one."""
    n, most = len(own.body), max(o for o in own.off) + 1
    out = np.zeros((n, max(own.n_win)), bool)
    table = np.full((most - 1 + width, n), OUTSIDE, np.uint8)  # column of the anchor: most - 1
    for i, (body, off) in enumerate(zip(own.body, own.off, strict=True)):
        at = most - 1 - off
        table[at:at + len(body), i] = np.frombuffer(body, np.uint8)
    _, group = np.unique(own.g, return_inverse=True)
    order = np.argsort(group, kind="stable")
    group = group.astype(np.uint16)
    members = [order[k::shards] for k in range(min(shards, n))]
    parts = [ShardTransform(table[:, m], group[m]) for m in members]
    off, n_win = np.array(own.off), np.array(own.n_win)
    for c, source, prefix in merge(parts, width):
        if c >= most:
            continue
        whole = prefix >= width
        hit = whole.copy()
        hit[:-1] |= whole[1:]
        for k, (m, s) in enumerate(zip(members, parts, strict=True)):
            strings = m[s.order[c][hit[source == k]]]
            j = c - (most - 1 - off[strings])  # the window's number in its string
            fits = (j >= 0) & (j < n_win[strings])
            out[strings[fits], j[fits]] = True
    return out


def _solver(width: int):
    def solve(own: Strings) -> list[bytes | None]:
        often = np.array(own.n) > 1
        several = np.flatnonzero(~often)
        flags = np.zeros((len(own.n), max(own.n_win)), bool)
        flags[often] = True
        # strings of anchors that have one string only are settled
        g = np.array(own.g)
        _, inverse, count = np.unique(g, return_inverse=True, return_counts=True)
        need = np.flatnonzero(count[inverse] > 1)
        if len(several) and len(need):
            part = Strings([[own.g[i], own.n_win[i], own.off[i], own.body[i], own.n[i], own.least[i]] for i in need.tolist()])
            found = repeated_windows(part, width)
            flags[need[:, None], np.arange(found.shape[1])[None, :]] |= found
        return [np.packbits(f[:k]).tobytes() if f[:k].any() else None for f, k in zip(flags, own.n_win, strict=True)]

    return solve


def remove_repeats(docs: DataFrame, width: int = 200, gram: int = 32, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    (and ``kept``, the remaining bytes, if ``with_text``)."""
    work = Workspace(docs.sparkSession, "suffix-dedup")
    w = Windows("byte", width, gram)
    rows = keyed(docs, ids_differ(docs))
    spans = marked(rows, w, work, F.col("n") > 1, _solver(width),
                   lambda totals, _: np.packbits(np.array(totals) > 1).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for raw, items in zip(part["text"].cast(pa.binary()).to_pylist(), part["spans"].to_pylist(), strict=True):
                n = len(raw)
                begin = [np.zeros(0, np.int64)]
                for item in items or []:
                    begin.append(item["p0"] + np.flatnonzero(np.unpackbits(np.frombuffer(item["marks"], np.uint8))))
                begin = np.unique(np.concatenate(begin))
                gone = covered(begin, begin + width, n) if len(begin) else np.zeros(n, bool)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8)]))
                for c, v in zip(out, (n, int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    out[c].append(v)
            if not with_text:
                del out["kept"]
            kinds = {"kept_sha256": pa.string(), "kept": pa.binary()}
            yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items())],
                                             ["doc_id", *out])

    return (rows.join(spans, KEY, "left").select("doc_id", "text", "spans")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")))
