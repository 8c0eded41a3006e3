"""Operator 1 - token counts by count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each
position; dynamic programming carries the best score and the number of pieces
of the best segmentation, never the segmentation itself.  Ties go as in the
unigram tokenizer: at each position the first best arc in order of its start
wins, i.e. the longest.  A character that no piece covers alone may be taken
as unknown at 10 below the smallest score, and counts one piece for each byte.

The distinct units (words with their leading spaces) of a slice are worked
abreast; a text's count is the sum over its units.  No shuffle; memory is a
slice of texts and the vocabulary's tables.

Defined results: a null or empty text has no pieces; repeated rows give
repeated, equal rows; a null ``doc_id`` is passed through; an empty table
gives no rows; other columns are ignored; a text without any space is one
unit, whose work is linear in its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadweave.llm.pieces import Pieces, Units, lattice_steps, pieces, units
from threadweave.llm.textcols import id_text, slices, sums

SLICE = 16 << 20


def best_counts(p: Pieces, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best score, pieces, and byte pieces among them, for each distinct unit."""
    n = len(u.begin) - 1
    best = np.full(len(u.data) + n, -np.inf)
    count = np.zeros(len(best), np.int64)
    unknown = np.zeros(len(best), np.int64)
    best[u.begin[:-1] + np.arange(n)] = 0
    for nodes, chain in lattice_steps(p, u):
        for arc in chain:
            score = best[arc.source] + arc.score
            node = nodes[arc.at]
            better = score > best[node]
            node, source = node[better], arc.source[better]
            extra = np.where(arc.piece[better] < 0, node - source, 0)
            best[node] = score[better]
            unknown[node] = unknown[source] + extra
            count[node] = count[source] + np.maximum(extra, 1)
    last = u.begin[1:] + np.arange(n)
    return best[last], count[last], unknown[last]


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per document: pieces, byte pieces among them, and the best score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model_file)
        for part in slices(batches, SLICE):
            u = units(part["text"])
            score, count, unknown = best_counts(vocabulary, u)
            total = np.concatenate([[0.0], np.cumsum(score[u.codes])])
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"], "n_tokens": sums(count[u.codes], u.starts),
                "n_byte_tokens": sums(unknown[u.codes], u.starts),
                "best_score": total[u.starts[1:]] - total[u.starts[:-1]]})

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, n_byte_tokens long, best_score double")
