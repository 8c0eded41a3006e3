"""Operator 9 - scoring texts with a causal self-attention model.

Text: words ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case, each split into subword
ids of a public byte-level BPE (with a space in front), then one end id.

Model (numpy, trained here): a token's input row, one head of causal attention
with a bias for each distance, a residual, and a softmax over *classes* of the
next id (by leading space and first character of the piece, fixed by the
vocabulary).  Within a class an id has its share of the training ids of the
class that follow the same id, smoothed with its share of all training ids of
the class.  The table of followers has a row and a column for each of the
first ``pairs`` ids of the vocabulary and one for each class of the others, so
its size is fixed.  Probabilities over all ids sum to one.

* Training.  Every window of every training document gives gradients, once.
  Each task runs Adagrad over its windows from common starting weights; the
  weights are averaged over tasks, by windows, in a distributed aggregation by
  blocks of the parameter vector (its size is fixed by the vocabulary
  parameters).
* Counts of words, ids and pairs of ids come from all training documents.
* Scoring.  A text is cut in windows of ``2 * stride`` positions that overlap
  by half; the second half of each is scored, so each id is scored exactly
  once with at least ``stride`` positions of context, in batches of masked
  attention.

Base scores need the count of every word.  Words counted at least T times are
broadcast, with T a power of two such that at most ``frequent`` words qualify;
all other words go through a shuffle join on the word's 64-bit hash.

Defined results: a null or empty text has the end token only; repeated rows
each count and get a row; a null ``doc_id`` is a training document; without
training documents N = V = 0 and the model is its starting point; a very long
text is scored in chunks of windows (scores have no ties); an empty table gives no
rows; other columns are ignored.  The model's score depends on how the training
rows are dealt to tasks, as each task trains from the same start and the weights
are averaged once; base scores and counts do not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.llm.packing import byte_bpe
from threadweave.llm.tables import Workspace
from threadweave.llm.textcols import Words, end_to_end, id_text, lower_ascii, slices, sums, word_hashes, words

SLICE = 4 << 20
HELD_WORDS = 1 << 20  # word counts that a task holds until it merges or writes them
LN10 = log(10)
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


@dataclass(frozen=True)
class LmRules:
    """``rows``: input rows for the first so many ids (others share a row by
    class); ``dim``: width; ``stride``: scored positions of a window; ``batch``:
    windows of a training step; ``pairs``: ids with an own row and column in the
    table of followers; ``prior``: weight of the class share, in pairs."""

    rows: int = 4096
    dim: int = 16
    stride: int = 16
    batch: int = 64
    rate: float = 0.1
    pairs: int = 2048
    prior: float = 20.0
    frequent: int = 1_000_000
    seed: int = 7


@lru_cache(maxsize=2)
def subwords(ranks_file: str, rules: LmRules) -> Subwords:
    """One for all tasks of a worker."""
    return Subwords(ranks_file, rules)


class Subwords:
    """Ids, their classes and input rows.  The id after the vocabulary is the end."""

    def __init__(self, ranks_file: str, rules: LmRules):
        encoding = byte_bpe(ranks_file)
        self.encode = lambda text: encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int32)  # noqa: E731  special strings are text
        self.spaced = np.zeros(encoding.n_vocab, bool)
        n = encoding.n_vocab
        self.end = n
        kinds: dict[tuple[bool, str], int] = {}
        self.cls = np.zeros(n + 1, np.int64)
        for i in range(n):
            raw = encoding.decode_single_token_bytes(i)
            self.spaced[i] = raw[:1] == b" "
            body = raw[1:] if self.spaced[i] else raw
            c = chr(body[0]) if body else ""
            kind = c.lower() if c.isalpha() and c.isascii() else "0" if c.isdigit() else "high" if c > "\x7f" else "other"
            self.cls[i] = kinds.setdefault((body != raw, kind), len(kinds))
        self.cls[n] = len(kinds)
        self.classes = len(kinds) + 1
        self.row = np.where(np.arange(n + 1) < rules.rows, np.arange(n + 1), rules.rows + self.cls)
        self.start_row = rules.rows + self.classes  # before a text
        self.pad_row = self.start_row + 1
        self.n_rows = self.pad_row + 1
        self.slot = np.where(np.arange(n + 1) < rules.pairs, np.arange(n + 1), rules.pairs + self.cls)
        self.slots = rules.pairs + self.classes

    def before(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Row of the table of followers for each id: the id before it, or a
        text's start (which has the end's row, as no id follows an end)."""
        out = np.empty(len(ids), np.int64)
        out[1:] = self.slot[ids[:-1]]
        out[starts[:-1][np.diff(starts) > 0]] = self.slot[self.end]
        return out

    def _words(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words with a space in front: all ids, and each word's
        first place and number.  Words are encoded in one string, where a piece
        with a leading space begins a word; words with white space beyond ASCII,
        which could meet a neighbour's, are encoded alone."""
        joined = end_to_end(vocab, " ").as_py() if len(vocab) else ""
        own = {}
        if OTHER_SPACE.search(joined):
            texts = vocab.to_pylist()
            own = {i: self.encode(" " + x) for i, x in enumerate(texts) if OTHER_SPACE.search(x)}
            joined = " ".join("a" if i in own else x for i, x in enumerate(texts))
        flat = self.encode(" " + joined) if len(vocab) else np.zeros(0, np.int32)
        at = np.flatnonzero(self.spaced[flat])
        size = np.diff(at, append=len(flat))
        for i, x in own.items():
            at[i], size[i] = len(flat), len(x)
            flat = np.concatenate([flat, x])
        return flat, at, size

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, end to end, with the end id; and where they begin."""
        flat, at, size = self._words(w.vocab)
        # the end id is one more word, the last of each text
        flat, at, size = np.append(flat, np.int32(self.end)), np.append(at, len(flat)), np.append(size, 1)
        codes = np.insert(w.codes, w.starts[1:], len(w.vocab))
        ends = np.cumsum(size[codes])
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(at[codes] - ends + size[codes], size[codes])
        place += np.arange(total)
        return flat.take(place), np.concatenate([[0], ends])[w.starts + np.arange(len(w.starts))]


@dataclass
class Weights:
    emb: np.ndarray
    wq: np.ndarray
    wk: np.ndarray
    wv: np.ndarray
    dist: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(v: Subwords, rules: LmRules) -> Weights:
        rng, d = np.random.default_rng(rules.seed), rules.dim
        small = lambda *shape: (rng.standard_normal(shape) / np.sqrt(d)).astype(np.float32)
        return Weights(small(v.n_rows, d), small(d, d), small(d, d), small(d, d), np.zeros(2 * rules.stride, np.float32),
                       small(d, v.classes), np.zeros(v.classes, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def vector(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def like(self, vector: np.ndarray) -> Weights:
        out, at = [], 0
        for x in self.parts():
            out.append(vector[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Weights(*out)


def windows(ids: np.ndarray, starts: np.ndarray, v: Subwords, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Input rows and target ids (-1: none) of all texts in one layout: each
    text gets ``stride`` empty positions, then start row and ids, filled up to a
    multiple of ``stride``.  Any two neighbouring blocks are a window; the second
    is scored."""
    size = np.diff(starts)
    blocks = -(-size // stride) + 1
    base = (np.cumsum(blocks) - blocks) * stride + stride
    slot = np.repeat(base - starts[:-1], size) + np.arange(len(ids))
    rows = np.full(int(blocks.sum()) * stride, v.pad_row, np.int32)
    target = np.full(len(rows), -1, np.int32)
    target[slot] = ids
    first = np.zeros(len(ids), bool)
    first[starts[:-1]] = True
    before = np.empty(len(ids), np.int32)
    before[1:] = v.row[ids[:-1]]
    before[first] = v.start_row
    rows[slot] = before
    return rows, target


class Attention:
    """Forward and backward passes over a batch of windows."""

    def __init__(self, w: Weights, v: Subwords, stride: int):
        self.w, self.v, self.s = w, v, stride
        back = np.arange(stride)[:, None] + stride - np.arange(2 * stride)[None, :]  # distance from query to key
        self.back = np.clip(back, 0, None)
        self.closed = np.where(back < 0, np.float32(-1e4), np.float32(0))

    def forward(self, rows: np.ndarray):
        """``rows``: windows x 2 stride.  Class logits of the second halves, and what backward needs."""
        w, s = self.w, self.s
        e = w.emb[rows]
        q, k, val = e[:, s:] @ w.wq, e @ w.wk, e @ w.wv
        score = np.matmul(q, k.transpose(0, 2, 1)) * np.float32(1 / np.sqrt(w.wq.shape[0]))
        score += w.dist[self.back] + self.closed
        score += np.where(rows == self.v.pad_row, np.float32(-1e4), np.float32(0))[:, None, :]
        np.clip(score, -1e4, 50, out=score)
        p = np.exp(score, out=score)
        p /= p.sum(axis=2, keepdims=True) + np.float32(1e-30)
        h = e[:, s:] + np.matmul(p, val)
        return np.clip(h @ w.out + w.bias, -50, 50), (rows, e, q, k, val, p, h)

    def backward(self, logits: np.ndarray, kept, target: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy of the classes of ``target`` ids (-1: none)."""
        w, s = self.w, self.s
        rows, e, q, k, val, p, h = kept
        z = np.exp(logits)
        z /= z.sum(axis=2, keepdims=True)
        live = target >= 0
        i, j = np.nonzero(live)
        z[i, j, self.v.cls[target[i, j]]] -= 1
        z *= (live / max(1, len(i))).astype(np.float32)[:, :, None]
        dh = z @ w.out.T
        de = np.zeros_like(e)
        de[:, s:] = dh
        dp, dval = np.matmul(dh, val.transpose(0, 2, 1)), np.matmul(p.transpose(0, 2, 1), dh)
        ds = p * (dp - (dp * p).sum(axis=2, keepdims=True))
        ddist = np.bincount(self.back.ravel(), weights=np.where(self.closed < 0, 0, ds.sum(axis=0)).ravel(), minlength=2 * s).astype(np.float32)
        ds *= np.float32(1 / np.sqrt(w.wq.shape[0]))
        dq, dk = np.matmul(ds, k), np.matmul(ds.transpose(0, 2, 1), q)
        de[:, s:] += dq @ w.wq.T
        de += dk @ w.wk.T + dval @ w.wv.T
        demb = np.zeros_like(w.emb)
        np.add.at(demb, rows.ravel(), de.reshape(-1, e.shape[2]))
        demb[self.v.pad_row] = 0
        flat = lambda x: x.reshape(-1, x.shape[2])
        return [demb, flat(e[:, s:]).T @ flat(dq), flat(e).T @ flat(dk), flat(e).T @ flat(dval), ddist,
                flat(h).T @ flat(z), z.sum(axis=(0, 1))]


class Trainer:
    """Adagrad over batches of windows, from common starting weights.

    All weights but the input rows lie in one vector, as do their sums of
    squares; ``w`` and ``square`` are views of these."""

    def __init__(self, w: Weights, v: Subwords, rules: LmRules):
        self.v, self.rules, self.seen = v, rules, 0
        self.net = net = Attention(w, v, rules.stride)
        rest = w.parts()[1:]
        self.rest = np.concatenate([x.ravel() for x in rest])
        self.rest_square = np.full_like(self.rest, 1e-6)
        self.w = Weights(w.emb, *_views(self.rest, rest))
        self.square = [np.full_like(w.emb, 1e-6), *_views(self.rest_square, rest)]
        #: the open cells of a window by distance
        self.by_distance = ((net.back.ravel()[:, None] == np.arange(2 * rules.stride)) & (net.closed.ravel() == 0)[:, None]).astype(np.float32)
        self.key = np.int16 if v.n_rows < 1 << 15 else np.int32  # short keys sort faster

    def learn(self, ids: np.ndarray, starts: np.ndarray) -> None:
        s = self.rules.stride
        rows, target = windows(ids, starts, self.v, s)
        rows, target = rows.reshape(-1, s), target.reshape(-1, s)
        scored = np.flatnonzero((target[1:] >= 0).any(axis=1)) + 1
        for i in range(0, len(scored), self.rules.batch):
            a, b = scored[i], scored[min(i + self.rules.batch, len(scored)) - 1] + 1
            self.step(rows[a - 1:b], target[a:b])
        self.seen += len(scored)

    def step(self, rows: np.ndarray, target: np.ndarray) -> None:
        """One step over the windows of neighbouring blocks ``rows``; ``target``:
        ids of all blocks but the first.  The gradients are those of
        ``Attention``; windows share their blocks' keys and values, and only
        the input rows that occur are touched.  Empty positions are masked where
        a block is empty; those behind a text are closed to its ids, and have no
        target of their own."""
        w, net, s, d, n = self.w, self.net, self.rules.stride, self.w.emb.shape[1], len(target)
        scale = np.float32(1 / np.sqrt(d))
        flat_rows = rows.ravel()
        e = w.emb.take(flat_rows, axis=0)
        into = np.concatenate([w.wq * scale, w.wk, w.wv], axis=1)
        qkv = (e @ into).reshape(n + 1, s, 3 * d)
        q, keys, values = qkv[1:, :, :d], _pairs(qkv, d, 2 * d), _pairs(qkv, 2 * d, 3 * d)
        p = np.matmul(q, keys.transpose(0, 2, 1))
        p += w.dist[net.back] + net.closed
        if p.max() > 50:
            np.minimum(p, 50, out=p)
        np.exp(p, out=p)
        p[rows[:-1, 0] == self.v.pad_row, :, :s] = 0
        ones = np.ones((2 * s, 1), np.float32)  # sums by matrix product: faster over short rows
        p /= (p.reshape(-1, 2 * s) @ ones).reshape(n, s, 1) + np.float32(1e-30)
        seen = np.matmul(p, values).reshape(-1, d)
        h = e[s:] + seen
        z = h @ w.out
        z += w.bias
        if z.max() > 50 or z.min() < -50:
            np.clip(z, -50, 50, out=z)
        np.exp(z, out=z)
        wanted = target.ravel()
        live = np.flatnonzero(wanted >= 0)
        weight = np.zeros(len(wanted), np.float32)
        weight[live] = 1 / max(1, len(live))
        z *= (weight / (z @ np.ones(z.shape[1], np.float32)))[:, None]
        flat_z, own = z.ravel(), live * z.shape[1] + self.v.cls.take(wanted.take(live))
        flat_z[own] = flat_z.take(own) - weight.take(live)
        dh = z @ w.out.T
        dh3 = dh.reshape(n, s, d)
        dp = np.matmul(dh3, values.transpose(0, 2, 1))
        dp -= ((dh * seen) @ np.ones((d, 1), np.float32)).reshape(n, s, 1)
        dp *= p
        grad = np.zeros((n + 1, s, 3 * d), np.float32)
        later = np.empty((n, s, 3 * d), np.float32)  # a block is the second of its window and the first of the next
        np.matmul(dp, keys, out=later[:, :, :d])
        for i, x, y in ((d, dp, q), (2 * d, p, dh3)):
            x = x.transpose(0, 2, 1)
            np.matmul(x[:, :s], y, out=grad[:-1, :, i:i + d])
            np.matmul(x[:, s:], y, out=later[:, :, i:i + d])
        grad[1:] += later
        grad = grad.reshape(-1, 3 * d)
        de = grad @ into.T
        de[s:] += dh
        key = flat_rows.astype(self.key)
        order = np.argsort(key, kind="stable")
        by_row = key[order]
        first = np.flatnonzero(np.concatenate([[True], by_row[1:] != by_row[:-1]]))
        used, demb = flat_rows[order[first]], np.add.reduceat(de.take(order, axis=0), first, axis=0)
        demb[used == self.v.pad_row] = 0
        square = self.square[0].take(used, axis=0) + demb * demb
        self.square[0][used] = square
        w.emb[used] = w.emb.take(used, axis=0) - self.rules.rate * demb / np.sqrt(square)
        dinto = e.T @ grad
        dinto[:, :d] *= scale
        ddist = (np.ones(n, np.float32) @ dp.reshape(n, -1)) @ self.by_distance
        g = np.concatenate([*(dinto[:, i:i + d].ravel() for i in range(0, 3 * d, d)), ddist, (h.T @ z).ravel(),
                            np.ones(len(z), np.float32) @ z])
        self.rest_square += g * g
        self.rest -= self.rules.rate * g / np.sqrt(self.rest_square)


def _pairs(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """View of columns a to b of all windows: block i and the one after it (``x``: blocks x stride x columns)."""
    return np.ndarray((len(x) - 1, 2 * x.shape[1], b - a), x.dtype, x, a * x.itemsize, x.strides)


def _views(flat: np.ndarray, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Views of ``flat`` in the shapes of ``parts``, one after another."""
    ends = np.cumsum([x.size for x in parts])
    return [flat[b - x.size:b].reshape(x.shape) for x, b in zip(parts, ends, strict=True)]


class Shares:
    """Probability of an id within its class, given the id before it."""

    def __init__(self, v: Subwords, id_count: np.ndarray, pair_count: np.ndarray, prior: float):
        self.v, self.prior = v, prior
        share = (id_count + 0.5) / np.bincount(v.cls, weights=id_count + 0.5)[v.cls]
        self.share = share
        self.prior_share = prior * share
        #: share of an id in its column (1 unless the column stands for several ids)
        self.own = share / np.bincount(v.slot, weights=share, minlength=v.slots)[v.slot]
        self.pair = pair_count.astype(np.float32)
        class_of_slot = np.zeros(v.slots, np.int64)
        class_of_slot[v.slot] = v.cls
        of_class = class_of_slot[:, None] == np.arange(v.classes)
        self.by_class = (pair_count.reshape(v.slots, v.slots) @ of_class.astype(float)).astype(np.float32).ravel()

    def log(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        v, before = self.v, self.v.before(ids, starts)
        both = self.pair[before * v.slots + v.slot[ids]] * self.own[ids]
        return np.log((both + self.prior_share[ids]) / (self.by_class[before * v.classes + v.cls[ids]] + self.prior))


class Scorer:
    """Forward pass of ``Attention`` for scoring alone: queries, keys and values
    of all input rows are tables, and neighbouring blocks share theirs.  A column
    of ones beside the values gives the sums of attention and, divided by
    these, the ones that meet the bias."""

    def __init__(self, w: Weights, v: Subwords, stride: int):
        self.v, self.s = v, stride
        scale = np.float32(1 / np.sqrt(w.wq.shape[0]))
        beside = lambda x, c: np.concatenate([x, np.full((len(x), 1), c, np.float32)], axis=1)
        self.emb, self.q, self.k, self.v_ = beside(w.emb, 0), w.emb @ w.wq * scale, w.emb @ w.wk, beside(w.emb @ w.wv, 1)
        closed = Attention(w, v, stride)
        self.bias = w.dist[closed.back] + closed.closed
        self.out = np.concatenate([w.out, w.bias[None]])

    def class_logs(self, rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Log probability of class ``cls[i]`` at each position of blocks 1, 2, ... of ``rows`` (blocks x stride)."""
        s = self.s
        k, val = self.k.take(rows, axis=0), self.v_.take(rows, axis=0)
        p = np.matmul(self.q.take(rows[1:], axis=0), _pairs(k, 0, k.shape[2]).transpose(0, 2, 1))
        p += self.bias
        if p.max() > 50:
            np.minimum(p, 50, out=p)
        np.exp(p, out=p)
        pad = rows == self.v.pad_row
        padded = pad.any(axis=1)
        some = np.flatnonzero(padded[:-1] | padded[1:])
        if len(some):
            p[some] *= ~np.concatenate([pad[some], pad[some + 1]], axis=1)[:, None, :]
        h = np.matmul(p, _pairs(val, 0, val.shape[2])).reshape(len(cls), -1)
        h /= h[:, -1:] + np.float32(1e-30)
        h += self.emb.take(rows[1:].ravel(), axis=0)
        logits = h @ self.out
        if logits.max() > 50:
            np.minimum(logits, 50, out=logits)
        own = logits.ravel().take(np.arange(len(logits)) * logits.shape[1] + cls)
        return own - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], np.float32))


def score_ids(ids: np.ndarray, starts: np.ndarray, v: Subwords, scorer: Scorer, shares: Shares, chunk: int = 128) -> np.ndarray:
    """Log10 probability of each text."""
    s = scorer.s
    rows, target = windows(ids, starts, v, s)
    blocks, cls = rows.reshape(-1, s), v.cls[target]  # no target: any class, not counted below
    out = np.zeros(len(target))
    for i in range(1, len(blocks), chunk):
        j = min(i + chunk, len(blocks))
        out[i * s:j * s] = scorer.class_logs(blocks[i - 1:j], cls[i * s:j * s])
    return sums_float(out[target >= 0] + shares.log(ids, starts), starts) / LN10


def sums_float(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def _learn(train: DataFrame, ranks_file: str, rules: LmRules) -> DataFrame:
    """One pass over the training texts: rows (kind, key, n, weights) - word
    counts by hash, counts of ids and pairs, and a task's weights by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = subwords(ranks_file, rules)
        trainer = Trainer(Weights.start(v, rules), v, rules)
        id_count = np.zeros(v.end + 1, np.int64)
        pair_count = np.zeros(v.slots ** 2, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in slices(batches, SLICE):
            w = words(lower_ascii(part["text"]))
            ids, starts = v.of(w)
            id_count += np.bincount(ids, minlength=len(id_count))
            np.add.at(pair_count, v.before(ids, starts) * v.slots + v.slot[ids], 1)
            trainer.learn(ids, starts)
            held.append((word_hashes(w.vocab).view(np.int64), np.bincount(w.codes, minlength=len(w.vocab))))
            if sum(len(h) for h, _ in held) > HELD_WORDS:
                held = [_merged(held)]
                if len(held[0][0]) > HELD_WORDS // 2:
                    yield from _batches("word", *held.pop())
        if held:
            yield from _batches("word", *_merged(held))
        used = np.flatnonzero(id_count)
        yield _rows("id", used, id_count[used])
        used = np.flatnonzero(pair_count)
        yield _rows("pair", used, pair_count[used])
        if trainer.seen:
            vector = trainer.w.vector()
            parts = [vector[i:i + 1024] for i in range(0, len(vector), 1024)]
            yield _rows("weights", np.arange(len(parts)), np.full(len(parts), trainer.seen), [x.tobytes() for x in parts])

    return train.select("text").mapInArrow(run, "kind string, key long, n long, weights binary")


def _merged(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, each key once."""
    key, n = (np.concatenate(x) for x in zip(*counts, strict=True))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else order
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


def _batches(kind: str, key: np.ndarray, n: np.ndarray, rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(key), rows):
        yield _rows(kind, key[i:i + rows], n[i:i + rows])


def _rows(kind: str, key: np.ndarray, n: np.ndarray, weights: list[bytes] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"kind": pa.array([kind]).take(pa.array(np.zeros(len(key), np.int64))),
                                       "key": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64()),
                                       "weights": pa.array(weights, pa.binary()) if weights else pa.nulls(len(key), pa.binary())})


def _mean_weights(key, table):
    n = table["n"].to_numpy()
    share = n / n.sum()
    mean = sum(np.frombuffer(x, np.float32).astype(float) * y for x, y in zip(table["weights"].to_pylist(), share, strict=True))
    return pa.table({"key": [key[0].as_py()], "n": pa.array([int(n.sum())], pa.int64()),
                     "weights": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def mean_weights(parts: DataFrame, fan: int = 64) -> DataFrame:
    """(key, n, weights): the means of the tasks' blocks, weighted by n, combined in
    two levels, so a group holds about a ``fan``-th of the tasks' blocks, then
    ``fan`` of them."""
    lot = F.pmod(F.xxhash64("n", "weights"), F.lit(fan))
    form = "key long, n long, weights binary"
    return (parts.select("key", "n", "weights").groupBy("key", lot.alias("lot")).applyInArrow(_mean_weights, form)
            .groupBy("key").applyInArrow(_mean_weights, form))


@dataclass
class LanguageModel:
    """Weights, counts of ids and pairs (all of fixed size), and the table of word counts."""

    weights: np.ndarray | None
    id_count: np.ndarray
    pair_count: np.ndarray
    word_counts: DataFrame  # h, c
    tokens: int
    distinct: int
    texts: int


def train_lm(train: DataFrame, ranks_file: str, work: Workspace, rules: LmRules = LmRules()) -> LanguageModel:
    """Learn from all texts of ``train`` (column ``text``)."""
    learned, _ = work.write(_learn(train, ranks_file, rules), "learned")
    counts, distinct = work.write(learned.filter("kind = 'word'").groupBy(F.col("key").alias("h")).agg(F.sum("n").alias("c")), "words")
    n_words = counts.agg(F.sum("c")).first()[0] or 0
    v = subwords(ranks_file, rules)
    found = {}
    for kind, size in (("id", v.end + 1), ("pair", v.slots ** 2)):
        table = learned.filter(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # size rows at most
        found[kind] = np.zeros(size)
        found[kind][table["key"].to_numpy()] = table["n"].to_numpy()
    blocks = mean_weights(learned.filter("kind = 'weights'")).collect()
    vector = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(blocks, key=lambda r: r["key"])]) if blocks else None
    texts = int(found["id"][v.end])
    work.drop("learned")
    return LanguageModel(vector, found["id"], found["pair"], counts, n_words + texts, distinct + (texts > 0), texts)


def frequent_words(model: LanguageModel, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes and counts of the words counted T times or more, and T:
    the smallest power of two that at most ``limit`` words reach."""
    sizes = {r["k"]: r["n"] for r in model.word_counts.groupBy(F.floor(F.log2("c")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    k, total = max(sizes, default=0) + 1, 0
    while k > 0 and total + sizes.get(k - 1, 0) <= limit:
        k -= 1
        total += sizes.get(k, 0)
    table = model.word_counts.filter(F.floor(F.log2("c")) >= k).toArrow()
    h, c = (table[x].to_numpy() for x in ("h", "c"))
    order = np.argsort(h)
    return h[order], c[order], 1 << k


def score_texts(docs: DataFrame, model: LanguageModel, ranks_file: str, work: Workspace, rules: LmRules = LmRules()) -> DataFrame:
    """``docs``: doc_id, text, held_out.  One row per document with the base
    score over words and the model's score."""
    spark = docs.sparkSession
    hashes, counts, least = frequent_words(model, rules.frequent)
    shared = spark.sparkContext.broadcast((hashes, counts, model.weights, model.id_count, model.pair_count.astype(np.float32)))
    total, distinct, texts = model.tokens, model.distinct, model.texts
    log_all = np.log10(total + 0.5 * (distinct + 1))
    whole = least <= 1  # every training word is in the broadcast table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_h, own_c, vector, id_count, pair_count = shared.value
        v = subwords(ranks_file, rules)
        weights = Weights.start(v, rules)
        scorer = Scorer(weights.like(vector) if vector is not None else weights, v, rules.stride)
        shares = Shares(v, id_count, pair_count, rules.prior)
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for part in slices(batches, SLICE):
            w = words(lower_ascii(part["text"]))
            ids, starts = v.of(w)
            score = score_ids(ids, starts, v, scorer, shares)
            h = word_hashes(w.vocab).view(np.int64)
            order = np.argsort(h)  # lookups in order stay near each other
            at = np.empty(len(h), np.int64)
            at[order] = np.minimum(np.searchsorted(own_h, h[order]), max(len(own_h) - 1, 0))
            found = own_h[at] == h if len(own_h) else np.zeros(len(h), bool)
            c = np.where(found, own_c[at], 0) if len(own_h) else np.zeros(len(h), np.int64)
            here = found | whole
            base = np.where(here, np.log10(c + 0.5) - log_all, 0.0)
            rid = np.arange(row, row + part.num_rows)
            row += part.num_rows
            n = part.num_rows
            yield pa.RecordBatch.from_pydict({
                "rid": rid, "h": pa.nulls(n, pa.int64()), "n": np.diff(w.starts) + 1, "doc_id": part["doc_id"], "held_out": part["held_out"],
                "known": sums((c > 0)[w.codes], w.starts) + int(texts > 0),
                "base": sums_float(base[w.codes], w.starts) + np.log10(texts + 0.5) - log_all, "score": score})
            rare = np.flatnonzero(~here[w.codes])
            if len(rare):
                text = np.searchsorted(w.starts, rare, side="right") - 1
                pairs, times = np.unique(text * len(h) + w.codes[rare], return_counts=True)
                m = len(pairs)
                yield pa.RecordBatch.from_pydict({
                    "rid": rid[pairs // len(h)], "h": h[pairs % len(h)], "n": times, "doc_id": pa.nulls(m, pa.int64()),
                    "held_out": pa.nulls(m, pa.bool_()), "known": pa.nulls(m, pa.int64()), "base": pa.nulls(m, pa.float64()),
                    "score": pa.nulls(m, pa.float64())})

    parts, _ = work.write(docs.select("doc_id", "text", "held_out").mapInArrow(
        run, "rid long, h long, n long, doc_id long, held_out boolean, known long, base double, score double"), "parts")
    rare = (parts.filter("h IS NOT NULL").select("rid", "h", "n")
            .join(model.word_counts.filter(F.col("c") < least), "h", "left")
            .groupBy("rid").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"),
                                F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - float(log_all))).alias("rest")))
    return (parts.filter("h IS NULL").join(rare, "rid", "left")
            .select("doc_id", "held_out", F.col("n").alias("n_tokens"),
                    (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score"))


def lm_scores(docs: DataFrame, ranks_file: str, folds: int = 5, held: int = 1, rules: LmRules = LmRules()) -> DataFrame:
    """Learn from the documents whose crc32(doc_id as text) mod ``folds`` is
    not ``held``, and score all documents."""
    work = Workspace(docs.sparkSession, "lm-scoring")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    tagged = id_text(docs).withColumn("held_out", F.coalesce(fold == held, F.lit(False)))
    model = train_lm(tagged.filter("NOT held_out"), ranks_file, work, rules)
    return score_texts(tagged, model, ranks_file, work, rules)
