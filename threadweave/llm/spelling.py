"""Operator 11 - spelling variants by blocked Gram matrices of letter counts.

Words are the maximal runs of letters of all texts, counted over the corpus.
Two words are near if one inserted, deleted or replaced code point turns one
into the other; a word's form is its near word of the largest count, if that is
``ratio`` times its own at least.

A word's letter counts are a vector.  One replaced letter changes two counts by
one (squared distance 2), one inserted letter changes one (squared distance 1),
so near words lie in the same length block or in adjacent ones at a squared
distance of 1 or 2.  Squared distances of a block come from one matrix product
of its count vectors; pairs that pass are verified letter by letter.

Length blocks alone would make the products quadratic in the vocabulary, so
they are cut further without loss.  The alphabet is dealt to ``groups`` groups
of about equal weight.  A replaced letter touches at most two groups and an
inserted one touches one, so near words agree on the counts of all letters of
some ``groups - 2`` groups.  A block is a length, such a choice of groups and
their letters' counts.  Words go to the blocks of their own length, and to
enough blocks of the next length to meet every word with one letter more.  A
pair counts in the first block that it shares.

Scale: texts are not shuffled, only counts combined in the tasks.  A word gives
a fixed number of rows (13 at five groups) of its own size.  Blocks of more than ``tile``
rows are cut into tiles of two parts, so no task holds an unbounded block.
Tiles give one row for each word with near words, never pairs.  Roots come from
pointer doubling in written rounds; counts at least double along a chain, so
there are few.

Defined results: a null text has no words, a null ``doc_id`` is an empty string
in the hashed key; runs of any length are whole words (a very long one needs
memory for itself); of near words with equal counts the smallest in code-point
order is the form; repeated rows count again; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.llm.tables import Workspace, small
from threadweave.llm.textcols import MIX, id_text, mix, slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
#: Distinct words that a task counts before it passes them on.
HELD = 200_000
#: Code points up to which words are verified in arrays.
SHORT = 48
#: Rows of a matrix product.
SLAB = 128


def damaged(doc_id: int | None, run: str, every: int) -> str:
    """``run`` without one letter if the hash of its document and itself says so."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, every: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points that occur at least
    ``least`` times; one letter is deleted from about one in ``every`` kinds of
    run of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return rows

        for part in slices(batches):
            for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                for w, n in Counter(RUN.findall(text.translate(LOWER))).items():
                    if len(w) >= shortest and len(w := damaged(doc, w, every)) >= shortest:
                        total[w] += n
                if len(total) >= HELD:
                    yield out()
        yield out()

    counts = id_text(docs).mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").cast("long").alias("n")).filter(F.col("n") >= least)


def letter_groups(weights: dict[str, int], groups: int) -> list[int]:
    """The group of each letter of ``LETTERS``: heaviest first, each to the
    lightest group so far."""
    load, of = [0] * groups, [0] * len(LETTERS)
    for weight, k in sorted(((weights.get(c, 0), k) for k, c in enumerate(LETTERS)), key=lambda x: (-x[0], x[1])):
        lightest = min(range(groups), key=lambda g: (load[g], g))
        of[k] = lightest
        load[lightest] += weight + 1
    return of


def agreeing(groups: int) -> tuple[list[tuple[int, ...]], list[int]]:
    """All choices of ``groups - 2`` groups, and the places of enough of them
    that each group is left out by one (for words that differ in one letter)."""
    choices = list(combinations(range(groups), groups - 2))
    left, cover = set(range(groups)), []
    while left:
        best = max(range(len(choices)), key=lambda c: (len(left - set(choices[c])), -c))
        cover.append(best)
        left &= set(choices[best])
    return choices, sorted(cover)


def _letter_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words as places in ``LETTERS``, and the words' lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-16-le"), "<u2").astype(np.int64)
    return np.where(points >= 0xC0, points - 0xC0 + 26, points - ord("a")), size


def _blocked(words: DataFrame, of: list[int], groups: int) -> DataFrame:
    """(key, home, word, n): the blocks that each word goes to; ``home`` if they
    are blocks of its own length."""
    choices, cover = agreeing(groups)
    group = np.array(of)
    salt = mix(np.arange(1, len(LETTERS) + 1, dtype=np.uint64) * MIX)  # a letter's share of its group's sum
    weight = np.zeros((groups, len(LETTERS)), np.uint64)
    weight[group, np.arange(len(LETTERS))] = salt

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, size = _letter_ids(b["word"].to_pylist())
            begin = np.cumsum(size) - size
            part = [np.add.reduceat(weight[g][ids], begin) for g in range(groups)]  # sums of salts: equal counts, equal sums
            for c, chosen in enumerate(choices):
                base = np.full(b.num_rows, c + 1, np.uint64)
                for g in chosen:
                    base = mix(base * MIX + part[g])
                for longer in ((0, 1) if c in cover else (0,)):
                    key = mix(base * MIX + (size + longer).astype(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(b.num_rows, c, np.int32)), pa.array(np.full(b.num_rows, not longer)),
                         b["word"], b["n"]], ["key", "choice", "home", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, choice int, home boolean, word string, n long")


def _tiles(rows: DataFrame, tile: int, work: Workspace) -> DataFrame:
    """``rows`` with (i, j): a block of up to ``tile`` rows is tile (0, 0); a
    larger one is cut into parts, and each two parts meet in one tile."""
    big = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > tile)
    big, n_big = work.write(big.select("key", F.ceil(F.col("size") / tile).cast("int").alias("parts")), "big")
    if not n_big:
        return rows.withColumn("part", F.lit(0)).withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    rows = rows.join(small(big, n_big), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("word"), "parts").cast("int")
    meet = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                       lambda x: F.struct(F.least("part", x).alias("i"), F.greatest("part", x).alias("j")))
    return rows.withColumn("part", part).withColumn("at", F.explode(meet)).select("key", "choice", "home", "word", "n", "part", "at.*")


class _Pairs:
    """Near words among rows of whole blocks (or of one tile)."""

    def __init__(self, t: pa.Table, of: np.ndarray, choices: list[tuple[int, ...]], cover: list[int]):
        self.words, self.n = t["word"].to_pylist(), t["n"].to_numpy()
        self.block, self.home, self.part, self.choice = (t[c].to_numpy() for c in ("block", "home", "part", "choice"))
        self.two = t["i"].to_numpy() != t["j"].to_numpy()
        self.of, self.choices, self.cover = of, choices, cover
        ids, self.size = _letter_ids(self.words)
        row = np.repeat(np.arange(len(self.words)), self.size)
        exact = np.float32 if self.size.max() <= 2000 else np.float64  # products stay below 2**24, or 2**53
        self.counts = np.bincount(row * len(LETTERS) + ids, minlength=len(self.words) * len(LETTERS)).reshape(-1, len(LETTERS)).astype(exact)
        self.square = (self.counts ** 2).sum(axis=1)
        self.short = self.size <= SHORT
        width = min(SHORT, int(self.size.max()))
        place = np.arange(len(row)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        inside = self.short[row]
        self.left = np.full((len(self.words), width + 1), 255, np.uint8)
        self.right = self.left.copy()
        self.left[row[inside], place[inside]] = ids[inside]
        self.right[row[inside], (self.size[row] - 1 - place)[inside]] = ids[inside]

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows (a, b) of near words: b at home, a at home or a letter shorter."""
        found = [self._product(slice(x, x + 4 * SLAB), slice(y, y + 4 * SLAB))
                 for x in range(0, len(self.words), 4 * SLAB) for y in range(0, len(self.words), 4 * SLAB)]
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return self._verified(a, b)

    def _product(self, rows: slice, cols: slice) -> tuple[np.ndarray, np.ndarray]:
        gram = self.counts[rows] @ self.counts[cols].T
        distance = self.square[rows, None] + self.square[None, cols] - 2 * gram
        a, b = np.nonzero(distance <= 2)
        a, b = a + rows.start, b + cols.start
        grown = self.size[b] - self.size[a]
        ok = (self.block[a] == self.block[b]) & self.home[b] & np.where(self.home[a], (grown == 0) & (a < b), grown == 1)
        ok &= ~self.two[b] | (self.part[a] != self.part[b])  # parts of a cut block meet themselves in their own tile
        return a[ok], b[ok]

    def _verified(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = np.zeros(len(a), bool)
        fast = self.short[a] & self.short[b]
        x, y = a[fast], b[fast]
        before = np.argmin(np.pad(self.left[x] == self.left[y], ((0, 0), (0, 1))), axis=1)
        after = np.argmin(np.pad(self.right[x] == self.right[y], ((0, 0), (0, 1))), axis=1)
        same = self.size[x] == self.size[y]
        one[fast] = np.where(same, before + after == self.size[x] - 1, before + after >= self.size[x])
        for k in np.flatnonzero(~fast):
            one[k] = one_edit(self.words[a[k]], self.words[b[k]])
        a, b = a[one], b[one]
        return self._first(a, b)

    def _first(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those pairs whose block is the first that both words go to."""
        changed = self.counts[a] != self.counts[b]
        touched = np.stack([changed[:, self.of == g].any(axis=1) for g in range(int(max(max(c) for c in self.choices)) + 1)], axis=1) \
            if len(a) else np.zeros((0, 1), bool)
        first = np.full(len(a), -1)
        for c in reversed(range(len(self.choices))):
            agree = ~touched[:, list(self.choices[c])].any(axis=1) if len(a) else np.zeros(0, bool)
            if c not in self.cover:
                agree &= self.size[a] == self.size[b]
            first[agree] = c
        mine = first == self.choice[b]
        return a[mine], b[mine]

    def rows(self) -> pa.RecordBatch | None:
        """(word, n_near, form, form_n) of the words with near words here."""
        a, b = self.near()
        if not len(a):
            return None
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        order = sorted(range(len(self.words)), key=lambda k: (-self.n[k], self.words[k]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        best = np.full(len(order), len(order))
        np.minimum.at(best, a, rank[b])
        some = np.flatnonzero(best < len(order))
        form = np.array(order)[best[some]]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.words[k] for k in some]), pa.array(np.bincount(a, minlength=len(order))[some]),
             pa.array([self.words[k] for k in form]), pa.array(self.n[form])], ["word", "n_near", "form", "form_n"])


def one_edit(a: str, b: str) -> bool:
    """Whether one replaced code point, or one inserted into ``a``, gives ``b``."""
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:])


def near_words(words: DataFrame, work: Workspace, groups: int = 5, tile: int = 4096) -> DataFrame:
    """(word, n_near, form, form_n) for each of ``words`` (word, n) with near
    words: how many, the one of largest count, and that count."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    of = letter_groups({r["c"]: r["k"] for r in letters.collect()}, groups)  # one row per letter of the alphabet
    choices, cover = agreeing(groups)
    group_of = np.array(of)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Rows of whole blocks, about ``SLAB`` of them or one larger block."""
        held: list[pa.RecordBatch] = []

        def cut(last: bool) -> Iterator[pa.Table]:
            nonlocal held
            t = pa.Table.from_batches(held).combine_chunks()
            key, i, j = (t[c].to_numpy() for c in ("key", "i", "j"))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            begin = np.flatnonzero(new)
            t = t.append_column("block", pa.array(np.cumsum(new)))
            end = np.append(begin[1:], len(key))
            stop = len(begin) if last else len(begin) - 1  # the last block may go on in the next batch
            # a block without two rows, or without one at home, has no pairs
            home = np.concatenate([[0], np.cumsum(t["home"].to_numpy())])
            use = (end - begin > 1) & (home[end] > home[begin])
            use[stop:] = False
            rows = np.flatnonzero(np.repeat(use, end - begin))
            if len(rows):
                used = t.take(pa.array(rows)).combine_chunks()
                ends = np.concatenate([[0], np.cumsum((end - begin)[use])])
                at = 0
                while at < len(ends) - 1:
                    after = max(at + 1, int(np.searchsorted(ends, ends[at] + SLAB, side="right")) - 1)
                    yield used.slice(int(ends[at]), int(ends[after] - ends[at]))
                    at = after
            held = [] if last else t.drop_columns(["block"]).slice(int(begin[-1])).to_batches()

        for b in batches:
            if b.num_rows:
                held.append(b)
                yield from cut(False)
        if held:
            yield from cut(True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches):
            rows = _Pairs(t, group_of, choices, cover).rows()
            if rows is not None:
                yield rows

    tiles = _tiles(_blocked(words, of, groups), tile, work)
    dealt = tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = dealt.select("key", "i", "j", "choice", "home", "part", "word", "n").mapInArrow(run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n"))


def follow_forms(words: DataFrame, work: Workspace) -> DataFrame:
    """``words`` (word, form, ...) with ``root``: the end of the chain of forms."""
    step, moved = work.write(words.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots0")
    k = 0
    while moved:
        k += 1
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        jumped = step.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        table, _ = work.write(jumped, f"roots{k}")
        moved = table.filter("moved").limit(1).count()
        work.drop(f"roots{k - 1}")
        step = table.select("word", "root")
    return words.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, ratio: int = 2, every: int = 97, shortest: int = 5, least: int = 3,
                      groups: int = 5, tile: int = 4096) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    work = Workspace(docs.sparkSession, "spelling")
    words, _ = work.write(word_counts(docs, every, shortest, least), "words")
    near = near_words(words, work, groups, tile)
    big = F.col("form_n") >= ratio * F.col("n")
    forms, _ = work.write(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(big, F.col("form")).alias("form"),
        F.when(big, F.col("form_n")).cast("long").alias("form_n")), "forms")
    return follow_forms(forms, work).select("word", "n", "n_near", "form", "form_n", "root")
