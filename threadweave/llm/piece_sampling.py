"""Operator 3 - sampled piece segmentations, and lossless decoding.

Forward filtering: every lattice node gets the log of the summed weights
exp(alpha * score) of all segmentations that reach it.  Backward sampling:
from a unit's end, an arc is drawn with its share of the node's sum, until the
unit's start; this draws whole segmentations with their exact probabilities.
The draws' uniform numbers are a hash of (seed, row key, unit, step), so a row
gets the same segmentation in every run, partitioning and retry.

Forward sums belong to the distinct units of a slice; draws are made for all
their occurrences abreast.  Unknown characters become byte pieces, spaces one
piece character each, so decoding gives back the exact bytes.

No shuffle.  Defined results: a null or empty text has no ids and decodes to
the empty text; rows with equal key and text get equal ids; a null ``doc_id``
counts as a key of its own; a very long text is sampled in chunks of its lattice
(a sample has no ties); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadweave.llm.pieces import SPACE, Pieces, Units, lattice_steps, pieces, units
from threadweave.llm.shipping import ship
from threadweave.llm.textcols import MIX, id_text, mix, slices

SLICE = 4 << 20
NO_ARC = -2


def _times(n: int) -> np.uint64:
    """n times the mixing constant, modulo 2**64."""
    return np.uint64(n * int(MIX) % (1 << 64))


class Filtered:
    """Forward sums of the units' lattices: the arcs into each node, and the
    running share of each in the node's sum."""

    def __init__(self, p: Pieces, u: Units, alpha: float):
        n = len(u.begin) - 1
        self.unit_end = u.begin[1:] + np.arange(n)
        self.unit_start = u.begin[:-1] + np.arange(n)
        self.byte_of_node = np.arange(len(u.data) + n) - np.repeat(np.arange(n), np.diff(u.begin) + 1)
        total = np.full(len(u.data) + n, -np.inf)
        total[self.unit_start] = 0
        #: per rank in a node's chain of arcs: source, piece (NO_ARC: none), running share by node
        self.source: list[np.ndarray] = []
        self.piece: list[np.ndarray] = []
        self.share: list[np.ndarray] = []
        for nodes, chain in lattice_steps(p, u):
            logs = [total[arc.source] + alpha * arc.score for arc in chain]
            top = np.full(len(nodes), -np.inf)
            for arc, log in zip(chain, logs, strict=True):
                top[arc.at] = np.maximum(top[arc.at], log)
            weights = [np.exp(log - top[arc.at]) for arc, log in zip(chain, logs, strict=True)]
            run, runs = np.zeros(len(nodes)), []
            for arc, weight in zip(chain, weights, strict=True):
                run[arc.at] += weight
                runs.append(run[arc.at])
            total[nodes] = top + np.log(run)
            rank = np.zeros(len(nodes), np.int8)  # an unknown character follows chains of any length
            for arc, upto in zip(chain, runs, strict=True):
                share = (upto / run[arc.at]).astype(np.float32)
                for k in np.unique(rank[arc.at]).tolist():
                    while len(self.share) <= k:
                        self.source.append(np.zeros(len(total), np.int32))
                        self.piece.append(np.full(len(total), NO_ARC, np.int32))
                        self.share.append(np.zeros(len(total), np.float32))
                    own = slice(None) if (rank[arc.at] == k).all() else rank[arc.at] == k
                    node = nodes[arc.at[own]]
                    self.source[k][node], self.piece[k][node], self.share[k][node] = arc.source[own], arc.piece[own], share[own]
                rank[arc.at] += 1
        self.log_total = total[self.unit_end]


def sample(p: Pieces, u: Units, key: np.ndarray, alpha: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and where each text's begin.  ``key``: a
    uint64 for each text."""
    f = Filtered(p, u, alpha)
    text = np.repeat(np.arange(len(key)), np.diff(u.starts))
    ordinal = (np.arange(len(u.codes)) - u.starts[text]).astype(np.uint64)
    stream = mix(mix(key + _times(seed))[text] + ordinal * MIX)
    occ, node, step = np.arange(len(u.codes), dtype=np.int32), f.unit_end[u.codes].astype(np.int32), 0
    first = f.unit_start[u.codes].astype(np.int32)
    drawn: list[tuple[np.ndarray, ...]] = []
    while len(occ):
        step += 1
        r = (mix(stream[occ] + _times(step)) >> np.uint64(11)).astype(float) / float(1 << 53)
        source, piece, open_ = f.source[0][node], f.piece[0][node], np.flatnonzero(r >= f.share[0][node])
        for k in range(1, len(f.share)):
            if not len(open_):
                break
            at = node[open_]
            real = f.piece[k][at] != NO_ARC  # where the chain ends, its last arc stands
            open_, at = open_[real], at[real]
            source[open_], piece[open_] = f.source[k][at], f.piece[k][at]
            open_ = open_[r[open_] >= f.share[k][at]]
        drawn.append((occ, piece, source, node))
        go = source > first[occ]
        occ, node = occ[go], source[go]
    if not drawn:
        return np.zeros(0, np.int32), np.zeros(len(key) + 1, np.int64)
    # an occurrence's steps ran backwards from its end: lay them out from its last step to its first
    steps = np.bincount(np.concatenate([x[0] for x in drawn]), minlength=len(u.codes))
    end = np.cumsum(steps)
    piece, source, node = (np.empty(int(end[-1]), np.int32) for _ in range(3))
    for k, (o, pc, sc, nd) in enumerate(drawn):
        slot = end[o] - 1 - k
        piece[slot], source[slot], node[slot] = pc, sc, nd
    owner = np.repeat(text, steps)
    width = np.where(piece < 0, node - source, 1)  # an unknown character: a piece for each byte
    ids = np.repeat(piece, width)
    raw = np.flatnonzero(ids < 0)
    within = (np.arange(len(ids)) - np.repeat(np.cumsum(width) - width, width))[raw]
    ids[raw] = p.byte_id[u.data[f.byte_of_node[np.repeat(source, width)[raw]] + within]]
    count = np.bincount(owner, weights=width, minlength=len(key)).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(count)])


def decode(p: Pieces, ids: np.ndarray, starts: np.ndarray, chunk: int = 500_000) -> list[str]:
    """The texts that the ids came from, about ``chunk`` ids at a time."""
    out, first = [], 0
    while first < len(starts) - 1:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + chunk, side="right")) - 1)
        own = ids[starts[first]:starts[last]]
        size = p.length[own]
        at = np.concatenate([[0], np.cumsum(size)])
        data = p.flat[np.repeat(p.flat_at[own] - at[:-1], size) + np.arange(int(at[-1]))]
        data[data == SPACE] = 0x20
        text, cut = data.tobytes(), at[starts[first:last + 1] - starts[first]].tolist()
        out += [text[i + 1:j].decode() for i, j in zip(cut[:-1], cut[1:], strict=True)]
        first = last
    return out


def sample_pieces(docs: DataFrame, model_file: str, alpha: float = 0.001, seed: int = 1) -> DataFrame:
    """One row per document: its number of ids, the ids, and whether they decode to the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for part in slices(batches, SLICE):
            key = part["doc_id"].cast(pa.int64())
            missing = key.is_null().to_numpy(zero_copy_only=False)
            number = key.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            ids, starts = sample(p, units(part["text"]), mix(number + missing.astype(np.uint64) * MIX), alpha, seed)
            same = [a == b for a, b in zip(decode(p, ids, starts), part["text"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"], "n_pieces": np.diff(starts),
                "ids": pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())), "lossless": same})

    return id_text(docs).mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decode_pieces(encoded: DataFrame, model_file: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids`` (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for part in batches:
            lists = part["ids"].fill_null([])
            texts = decode(p, lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets.to_numpy()[0])
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "text": pa.array(texts, pa.string())})

    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
