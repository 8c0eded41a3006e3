"""Arrow helpers shared by the text operators: bounded slices of a batch and
white-space words as integer codes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadweave.llm.shipping import ship

SLICE_BYTES = 4 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def id_text(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` (long) and ``text`` of a documents table, and columns of the
    caller's choice; a null text is empty.

    Any other column is left behind here, so columns with clashing names never
    meet an operator's own."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def slices(batches: Iterable[pa.RecordBatch], max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches with a ``text`` column into slices of about
    ``max_bytes`` of text, so that a task's working memory does not depend on
    how many rows Spark puts in a batch.  A longer text is a slice by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        end = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            base = end[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(end, base + max_bytes, side="right")))
            yield batch.slice(first, last - first)
            first = last
        pa.default_memory_pool().release_unused()  # a worker lives on after its task


class Words(NamedTuple):
    """Words of n texts: ``codes[starts[i]:starts[i + 1]]`` are text i's words
    as indices into ``vocab`` (distinct words of the slice)."""

    codes: np.ndarray
    starts: np.ndarray
    vocab: pa.Array

    def owner(self) -> np.ndarray:
        """Text index of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def words(texts: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    keep = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = flat.filter(real).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), keep[offsets - offsets[0]], coded.dictionary)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values[starts[i]:starts[i + 1]]`` for each i."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a span [begin, end)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (each bit depends on all bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def end_to_end(texts: pa.Array, between: str = "") -> pa.Scalar:
    """All texts in one, with ``between`` between them (no nulls)."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), pa.scalar(between, texts.type))[0]


#: pseudo-random numbers of the bytes at the first places of a word
BYTE_HASHES = mix((np.arange(32 * 256, dtype=np.uint64) + np.uint64(1)) * MIX)


def word_hashes(vocab: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words: the sum of one pseudo-random number for
    each byte and its place, mixed."""
    size = pc.binary_length(vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return mix(np.full(len(vocab), MIX))
    place = np.arange(ends[-1])
    place -= np.repeat(ends - size, size)
    place *= 256
    place += np.frombuffer(end_to_end(vocab).as_buffer(), np.uint8)
    own = BYTE_HASHES.take(place, mode="clip")
    late = np.flatnonzero(place >= len(BYTE_HASHES))
    own[late] = mix((place[late].astype(np.uint64) + np.uint64(1)) * MIX)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)])
    return mix(total[ends] - total[ends - size] + MIX)


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z in lower case; other letters as they are."""
    return pc.ascii_lower(texts)
