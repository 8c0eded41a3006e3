"""Operator 4 - quality rules from suffix-array repetition.

For every text the words ``[^\\x20\\x09-\\x0D]+`` are sorted as suffixes (prefix
doubling over all texts of a slice at once; only positions that still tie are
sorted again), and longest-common-prefix values between neighbours come from
the rank tables of the doublings.  A text's repeated substrings are its LCP
intervals; those that can't be extended to the left are the maximal ones.
Their spans are united:

* ``n_repeat_words`` - words in the union for a minimum length of
  ``window`` words (words in 3-word windows found twice or more);
* the verdict limits the covered fraction and the longest repeat over maximal
  repeats of at least ``min_repeat`` words.

No shuffle: each text is judged alone, in one pass over the table.  Memory per
task is a slice of texts (4 MB) or the longest single text.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows give repeated, equal result rows; a null ``doc_id`` is passed
through; a text exactly at a limit is kept; a very long text is a slice by itself
and needs its rank tables (words x log2 of its longest repeat, 8 bytes each); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from threadweave.llm.shipping import ship
from threadweave.llm.textcols import covered, id_text, slices, sums, words

SYMBOLS = b"#*$%&|<>"

SCHEMA = """doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
    base_failed boolean, kept boolean, n_covered_words long, longest_repeat long, n_maximal_repeats long"""


@dataclass(frozen=True)
class RepetitionRules:
    """Limits.  Base: at least ``min_words`` words, at most ``max_repeat_pct`` percent of
    them in repeated ``window``-word windows.  Verdict, over maximal repeats of
    ``min_repeat`` words or more: at most ``max_covered`` of the words covered,
    and no repeat longer than ``max_longest`` of the words."""

    min_words: int = 50
    window: int = 3
    max_repeat_pct: int = 50
    min_repeat: int = 10
    max_covered: float = 0.4
    max_longest: float = 0.25


def suffix_ranks(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of several sequences laid end to end, and the rank tables.

    ``levels[j][i]`` is the dense rank of the first 2**j words at position i
    within its sequence (a suffix that ends earlier sorts first), so two
    positions share a rank exactly if those words are equal and both present,
    or both suffixes are equal and end there."""
    n = len(codes)
    key = owner * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # rank: first place of the block
    last = np.searchsorted(owner, owner, side="right")  # end of the own sequence
    levels, width = [rank], 1
    while True:
        # positions that still tie, in the order found so far: blocks of equal rank
        tie = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
        if not len(tie):
            return order, levels
        at = order[tie]
        block = rank[at]
        beyond = at + width
        second = np.where(beyond < last[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
        inner = np.lexsort((second, block))
        at, block, second = at[inner], block[inner], second[inner]
        order = order.copy()
        order[tie] = at
        differs = np.concatenate([[True], (block[1:] != block[:-1]) | (second[1:] != second[:-1])])
        new = new.copy()
        new[tie] = differs
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(differs, tie, 0))
        levels.append(rank)
        width *= 2


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray], owner: np.ndarray) -> np.ndarray:
    """Longest common prefix of ``order[i - 1]`` and ``order[i]`` (0 at i = 0 and
    between sequences), descending through the rank tables."""
    n = len(order)
    last = np.searchsorted(owner, owner, side="right")
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    pair = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[pair - 1].copy(), order[pair].copy()
    end = np.maximum(last[a], last[b])
    length = np.zeros(len(pair), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        step = 1 << j
        fits = (np.maximum(a, b) + step) <= end  # both lie in the same sequence, which ends at ``end``
        same = fits & (levels[j][np.minimum(a, n - 1)] == levels[j][np.minimum(b, n - 1)])
        a, b, length = a + step * same, b + step * same, length + step * same
    out[pair] = length
    return out


def longest_repeats(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position, the length of its longest prefix that also starts
    elsewhere in the same sequence."""
    if not len(codes):
        return np.zeros(0, np.int64)
    order, levels = suffix_ranks(codes, owner)
    lcp = neighbour_lcp(order, levels, owner)
    out = np.empty(len(codes), np.int64)
    out[order] = np.maximum(lcp, np.concatenate([lcp[1:], [0]]))
    return out


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(lines.offsets.to_numpy()))
    wordy = pc.not_equal(pc.ascii_trim_whitespace(flat), "").to_numpy(zero_copy_only=False)
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row, code = row[wordy], code[wordy]
    distinct = np.unique(row * (int(code.max(initial=0)) + 1) + code) // (int(code.max(initial=0)) + 1)
    return np.bincount(row, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def _symbols(texts: pa.Array) -> np.ndarray:
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    table = np.zeros(256, np.int8)
    table[list(SYMBOLS)] = 1
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    return sums(table[data], np.concatenate([[0], np.cumsum(size)]))


def judge(texts: pa.Array, rules: RepetitionRules) -> dict[str, np.ndarray]:
    """All result columns but ``doc_id`` for one slice of texts."""
    w = words(texts)
    owner, n_words = w.owner(), np.diff(w.starts)
    repeat = longest_repeats(w.codes, owner)
    at = np.arange(len(repeat))
    small = at[repeat >= rules.window]
    n_repeat = sums(covered(small, small + rules.window, len(repeat)), w.starts)
    # maximal: the repeat one word earlier doesn't contain this one
    before = np.concatenate([[0], repeat[:-1]]) * np.concatenate([[False], owner[1:] == owner[:-1]])[: len(repeat)]
    span = at[(repeat >= rules.min_repeat) & (before != repeat + 1)]
    n_covered = sums(covered(span, span + repeat[span], len(repeat)), w.starts)
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, owner[span], repeat[span])
    chars = pc.utf8_length(w.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_pct * n_words)
    fine = (n_covered <= rules.max_covered * n_words) & (longest <= rules.max_longest * n_words)
    return {"n_words": n_words, "word_chars": sums(chars[w.codes], w.starts), "n_symbols": _symbols(texts),
            "n_dup_lines": _duplicate_lines(texts), "n_repeat_words": n_repeat, "base_failed": failed,
            "kept": ~failed & fine, "n_covered_words": n_covered, "longest_repeat": longest,
            "n_maximal_repeats": np.bincount(owner[span], minlength=len(n_words))}


def quality_rules(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """One row per document: counts, base rule, repetition figures and verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = judge(part["text"], rules)
            yield pa.RecordBatch.from_arrays([part["doc_id"], *map(pa.array, out.values())], ["doc_id", *out])

    return id_text(docs).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) that the verdict keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield part.filter(pa.array(judge(part["text"].fill_null(""), rules)["kept"]))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
