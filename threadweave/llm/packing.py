"""Operator 2 - packing examples into sequences by vector bin packing.

An example has a demand vector (tokens, segments = 1, loss-bearing tokens) and
a sequence has a capacity vector.  Loss-bearing are the tokens that begin in the
spans of a column (instruction data: the answers), or all; segments have no limit
by default.  The dot-product heuristic fills one
sequence at a time: of the waiting pieces that fit in every dimension, it
takes the one whose demand has the largest inner product with what is left of
the capacity (each dimension divided by its capacity).  Where nothing fits any
more and the sequence still has room for tokens and a segment, the piece with
the largest product is cut there, so that sequences come out full.  Examples
longer than a sequence are first cut into full sequences and a rest.

What is left when a task's input ends is laid out in sequences whose length is
a power of two, which need no padding.  Where the segments or the loss-bearing
tokens bind first, a sequence is cut back to a power of two as well.

Each task packs the rows it reads: no shuffle and no global state, tokens are
never held beyond a pool of ``pool`` waiting pieces, and a retried task gives
the same sequences.  A sequence's id is the partition number times 2**40 plus
a running number.

Defined results: a null or empty text has no tokens but the end id; repeated
rows are packed once for each row; of pieces with equal products the one that
waits at the lowest place goes first; a very long text is tokenized whole and
cut into full sequences; null spans bear no loss; a null ``doc_id`` is passed through; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.llm.textcols import id_text, slices


@dataclass(frozen=True)
class Limits:
    """Capacity of a sequence: tokens, segments (pieces; a piece has a token at
    least, so as many segments as tokens are no limit) and loss-bearing tokens."""

    tokens: int = 1024
    segments: int = 1024
    loss: int = 1024


@lru_cache(maxsize=2)
def byte_bpe(ranks_file: str):
    """The byte-level BPE of a ranks file; special strings get their ids, as
    the ``tokenizers`` file of the same vocabulary gives them."""
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name="byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": len(ranks)})


@dataclass
class Piece:
    """Part of an example: row number, first token, token count, loss-bearing count."""

    row: int
    start: int
    length: int
    loss: int


class Packer:
    """Fills sequences from a stream of examples; ``done`` collects
    (sequence, offset, piece) as sequences close.

    Waiting pieces lie in a list with their demand vectors in the rows of one
    array; a piece that leaves is replaced by the last one."""

    def __init__(self, limits: Limits, pool: int = 512):
        self.limits, self.pool = limits, pool
        self.waiting: list[Piece] = []
        self.need = np.zeros((4 * pool, 3))
        self.runs: dict[int, np.ndarray] = {}
        self.done: list[tuple[int, int, Piece]] = []
        self.sequence = 0
        self.tokens = 0  # in waiting pieces

    def add(self, row: int, length: int, loss: np.ndarray | None = None) -> None:
        """An example; ``loss``: running count of its loss-bearing tokens, length
        + 1 values from 0 (None: every token bears loss)."""
        if loss is not None:
            self.runs[row] = loss
        start = 0
        while start < length:
            n = min(length - start, self.limits.tokens)
            n = max(1, self._longest(row, start, n, self.limits.loss))
            piece = Piece(row, start, n, self._count(row, start, start + n))
            if n == self.limits.tokens:
                self._close([piece])
            else:
                self._wait(piece)
            start += n
        if len(self.waiting) >= 2 * self.pool:
            while len(self.waiting) > self.pool and self.tokens >= self.limits.tokens:
                self._fill(self.limits)

    def _count(self, row: int, a: int, b: int) -> int:
        run = self.runs.get(row)
        return b - a if run is None else int(run[b] - run[a])

    def _longest(self, row: int, start: int, n: int, most: int) -> int:
        """Tokens from ``start``, n at most, with ``most`` loss-bearing ones at most."""
        run = self.runs.get(row)
        if run is None:
            return min(n, most)
        return min(n, int(np.searchsorted(run, run[start] + most, side="right")) - 1 - start)

    def _wait(self, piece: Piece) -> None:
        at = len(self.waiting)
        if at == len(self.need):
            self.need = np.concatenate([self.need, np.zeros_like(self.need)])
        self.waiting.append(piece)
        self.need[at] = (piece.length, 1, piece.loss)
        self.tokens += piece.length

    def _take(self, i: int) -> Piece:
        piece, last = self.waiting[i], self.waiting.pop()
        if last is not piece:
            self.waiting[i] = last
            self.need[i] = self.need[len(self.waiting)]
        self.tokens -= piece.length
        return piece

    def _close(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.done.append((self.sequence, offset, p))
            offset += p.length
        self.sequence += 1

    def _fill(self, limits: Limits) -> None:
        """One sequence of the waiting pieces."""
        cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        left, taken = cap.copy(), []
        while left[0] > 0 and left[1] > 0 and self.waiting:
            need = self.need[:len(self.waiting)]
            score = need @ (left / cap ** 2)
            i = int(np.argmax(np.where((need <= left).all(axis=1), score, -1.0)))
            if (need[i] <= left).all():
                left -= need[i]
                taken.append(self._take(i))
                continue
            p = self._take(int(np.argmax(score)))
            n = self._longest(p.row, p.start, min(p.length, int(left[0])), int(left[2]))
            if n > 0:
                head = Piece(p.row, p.start, n, self._count(p.row, p.start, p.start + n))
                taken.append(head)
                self._wait(Piece(p.row, p.start + n, p.length - n, p.loss - head.loss))
            else:
                self._wait(p)
            break
        self._close(self._power_of_two(taken, limits.tokens))

    def _power_of_two(self, taken: list[Piece], full: int) -> list[Piece]:
        """A sequence that isn't full, cut back to a power of two; the rest waits again."""
        used = sum(p.length for p in taken)
        spare = 0 if used == full else used - (1 << (used.bit_length() - 1))
        while spare:
            p = taken.pop()
            n = max(0, p.length - spare)
            if n:
                head = Piece(p.row, p.start, n, self._count(p.row, p.start, p.start + n))
                taken.append(head)
                self._wait(Piece(p.row, p.start + n, p.length - n, p.loss - head.loss))
            else:
                self._wait(p)
            spare -= p.length - n
        return taken

    def finish(self) -> None:
        """Full sequences as long as there are tokens for them, then powers of two."""
        while self.waiting:
            room = self.limits.tokens if self.tokens >= self.limits.tokens else 1 << (self.tokens.bit_length() - 1)
            self._fill(Limits(room, self.limits.segments, self.limits.loss))


SCHEMA = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,
    loss_tokens long"""


def loss_counts(encode, ids: list[int], text: str, spans: list[dict] | None) -> np.ndarray:
    """Running count of the loss-bearing tokens of ``ids`` and an end id: those
    whose first character lies in one of ``spans`` (begin, end; code points), and
    the end id if the last character does."""
    inside = np.zeros(len(text) + 1, np.int64)
    for x in spans or ():
        inside[max(0, x["begin"]):max(0, x["end"])] = 1
    _, offsets = encode.decode_with_offsets(ids)
    end = inside[len(text) - 1] if text else 0
    return np.cumsum(np.concatenate([[0], inside[np.minimum(np.array(offsets, np.int64), len(text))], [end]]))


def pack_documents(docs: DataFrame, ranks_file: str, limits: Limits = Limits(), end_id: int = 0,
                   pool: int = 512, with_ids: bool = False, loss_spans: str | None = None) -> DataFrame:
    """Tokenize and pack whole texts; one row per piece, with its ids if
    ``with_ids``.  ``loss_spans``: the column (array of struct begin, end) of the
    spans of the text that bear loss; without it every token does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 40
        encode, special = byte_bpe(ranks_file), {"<|endoftext|>"}
        packer = Packer(limits, pool)
        held: dict[int, tuple[object, np.ndarray, int]] = {}  # row -> doc_id, ids, tokens not yet laid out
        row = 0

        def closed() -> Iterator[pa.RecordBatch]:
            done, packer.done = packer.done, []
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")}
            lists = []
            for sequence, offset, p in done:
                doc_id, ids, rest = held[p.row]
                own = ids[p.start:p.start + p.length]
                for k, v in zip(out, (doc_id, p.start, p.length, zlib.crc32(own.tobytes()), len(ids), base + sequence, offset, p.loss),
                                strict=True):
                    out[k].append(v)
                if with_ids:
                    lists.append(own)
                if rest == p.length:
                    del held[p.row]
                    packer.runs.pop(p.row, None)
                else:
                    held[p.row] = (doc_id, ids, rest - p.length)
            arrays = {k: pa.array(v, pa.int64()) for k, v in out.items()}
            if with_ids:
                arrays["ids"] = pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(arrays)

        for part in slices(batches):
            marked = [None] * part.num_rows if loss_spans is None else part["spans"].to_pylist()
            for doc_id, text, spans in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), marked, strict=True):
                own = encode.encode(text, allowed_special=special)
                ids = np.array([*own, end_id], dtype="<u4")
                held[row] = (doc_id, ids, len(ids))
                packer.add(row, len(ids), None if loss_spans is None else loss_counts(encode, own, text, spans))
                row += 1
            yield from closed()
        packer.finish()
        yield from closed()

    rows = id_text(docs) if loss_spans is None else id_text(docs, F.col(loss_spans).alias("spans"))
    return rows.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
