"""Operator 5 - removing repeated word spans with suffix automata.

A suffix automaton of reference passages answers, for a stream of words, the
longest suffix that occurs in the references (matching statistics).  Each
state carries the smallest document id of its occurrences, so the state of
the last ``width`` words tells whether they start in an earlier document.

``remove_reference_spans`` has a bounded reference (a benchmark, say): its
shards' automata are built in tasks, broadcast, and all documents are streamed
through each.

``remove_repeated_spans`` has the corpus itself as reference.  Broadcasting
automata of all its shards to all documents would take work with the square of
the corpus, so the shards are made by anchor (see ``anchored``): the passages
of an anchor - distinct, with the smallest document of each - are one shard's
references, and the documents' passages of that anchor are streamed through
it in the task that holds the automaton.  Where these are more than
``SHARD_WORDS``, shards of that size follow each other, and each passage keeps
the smallest id.  Passages that no other document shares are never shipped.

Defined results: a null or empty text has no words; a word is removed only for
a smaller ``doc_id``, so repeated rows lose nothing to each other; a row with a
null ``doc_id`` loses nothing and is no one's reference; equal ids tie and take
nothing from each other; a very long text is cut into anchored strings like any
other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.llm.anchored import KEY, NO_ID, Strings, Windows, ids_differ, keyed, marked
from threadweave.llm.tables import Workspace
from threadweave.llm.textcols import covered, id_text, slices

NEVER = (1 << 63) - 1
#: Words of one automaton's references, as its states are Python objects.  The
#: references of more are cut to shards, one in memory at a time.
SHARD_WORDS = 200_000


class SuffixAutomaton:
    """Generalised suffix automaton over words; ``least[s]`` is the smallest id
    of the passages that hold state s's strings."""

    def __init__(self, passages: Iterable[tuple[list[bytes], int]]):
        follow: list[dict[bytes, int]] = [{}]
        link, size, least = [-1], [0], [NEVER]

        def split(last: int, word: bytes, step: int) -> int:
            """A state for the strings of ``step`` that extend ``last`` by ``word``."""
            copy = len(size)
            follow.append(follow[step].copy())
            size.append(size[last] + 1)
            link.append(link[step])
            least.append(NEVER)
            while last >= 0 and follow[last].get(word) == step:
                follow[last][word] = copy
                last = link[last]
            link[step] = copy
            return copy

        for words, number in passages:
            last = 0
            for word in words:
                step = follow[last].get(word)
                if step is not None:
                    new = step if size[step] == size[last] + 1 else split(last, word, step)
                else:
                    new = len(size)
                    follow.append({})
                    size.append(size[last] + 1)
                    link.append(0)
                    least.append(NEVER)
                    while last >= 0 and word not in follow[last]:
                        follow[last][word] = new
                        last = link[last]
                    if last >= 0:
                        step = follow[last][word]
                        link[new] = step if size[step] == size[last] + 1 else split(last, word, step)
                if number < least[new]:
                    least[new] = number
                last = new
        for s in sorted(range(1, len(size)), key=size.__getitem__, reverse=True):
            if least[s] < least[link[s]]:
                least[link[s]] = least[s]
        self.next, self.link, self.size, self.least = follow, link, size, least

    def windows(self, words: list[bytes], width: int) -> list[int]:
        """For each window of ``width`` words, the smallest id of a passage that
        holds it, or NEVER: the matching statistics cut at ``width``."""
        follow, link, size = self.next, self.link, self.size
        out, at, matched = [], 0, 0
        for i, word in enumerate(words):
            step = follow[at].get(word)
            while step is None and at > 0:
                at = link[at]
                matched = size[at]
                step = follow[at].get(word)
            if step is not None:
                at, matched = step, matched + 1
                while size[link[at]] >= width:  # the state whose strings include the last ``width`` words
                    at = link[at]
                    matched = size[at]
            if i >= width - 1:
                out.append(self.least[at] if matched >= width else NEVER)
        return out


def _shards(split: dict[int, list[bytes]], references: Iterable[int]) -> Iterator[list[int]]:
    """The references in runs of at most ``SHARD_WORDS`` words."""
    part, held = [], 0
    for i in references:
        if part and held + len(split[i]) > SHARD_WORDS:
            yield part
            part, held = [], 0
        part.append(i)
        held += len(split[i])
    if part:
        yield part


def _solver(width: int):
    def solve(own: Strings) -> list[bytes | None]:
        g = np.array(own.g)
        _, inverse, count = np.unique(g, return_inverse=True, return_counts=True)
        shared = count[inverse] > 1
        split = {i: own.body[i].split() for i in np.flatnonzero(shared).tolist()}
        lowest: dict[int, list[int]] = {}

        def stream(part: list[int]) -> None:
            """The strings of the shard's anchors through its automaton, which ends with the call."""
            shard, own_anchors = SuffixAutomaton((split[i], own.least[i]) for i in part), {own.g[i] for i in part}
            for i, words in split.items():
                if own.g[i] in own_anchors:
                    found = shard.windows(words, width)
                    lowest[i] = list(map(min, lowest[i], found)) if i in lowest else found

        for part in _shards(split, (i for i in split if own.least[i] is not None)):
            stream(part)
        out: list[bytes | None] = []
        for i, (n, n_win, least) in enumerate(zip(own.n, own.n_win, own.least, strict=True)):
            if i in split:
                found = lowest.get(i) or [NEVER] * n_win
                out.append(np.array(found, np.int64).tobytes() if n > 1 or min(found) < (NEVER if least is None else least) else None)
            else:
                out.append(np.full(n_win, least, np.int64).tobytes() if n > 1 and least is not None else None)
        return out

    return solve


def _removal(width: int, with_text: bool):
    """Arrow function from doc_id, text, spans to the result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "kept")}
            for doc_id, raw, items in zip(part["doc_id"].to_pylist(), part["text"].cast(pa.binary()).to_pylist(), part["spans"].to_pylist(), strict=True):
                words = raw.split()
                begin = [np.zeros(0, np.int64)]
                for item in items or []:
                    if doc_id is not None:
                        begin.append(item["p0"] + np.flatnonzero(np.frombuffer(item["marks"], np.int64) < doc_id))
                begin = np.concatenate(begin)
                if len(begin):
                    gone = covered(begin, begin + width, len(words))
                    words = [x for x, g in zip(words, gone.tolist(), strict=True) if not g]
                    removed = int(gone.sum())
                else:
                    removed = 0
                kept = b" ".join(words)
                for c, v in zip(out, (len(words) + removed, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None), strict=True):
                    out[c].append(v)
            if not with_text:
                del out["kept"]
            kinds = {"kept_sha256": pa.string(), "kept": pa.string()}
            yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items())], ["doc_id", *out])

    return run


def _schema(with_text: bool) -> str:
    return "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")


def remove_repeated_spans(docs: DataFrame, width: int = 13, gram: int = 4, with_text: bool = False) -> DataFrame:
    """One row per document, without the words covered by a ``width``-word
    window that also starts in a document with a smaller id."""
    work = Workspace(docs.sparkSession, "substring-dedup")
    never = lambda totals, lowest: np.array([NEVER if x is None else x for x in lowest], np.int64).tobytes()
    rows = keyed(docs, ids_differ(docs))
    spans = marked(rows, Windows("word", width, gram), work, (F.col("n") > 1) & (F.col("hi") > F.col("lo")) & (F.col("hi") > NO_ID),
                   _solver(width), never, chunk=4_000)
    return (rows.join(spans, KEY, "left").select("doc_id", "text", "spans")
            .mapInArrow(_removal(width, with_text), _schema(with_text)))


def remove_reference_spans(docs: DataFrame, reference: DataFrame, width: int = 13, shards: int = 4, max_bytes: int = 64 << 20,
                           with_text: bool = False) -> DataFrame:
    """One row per document, without the words covered by a ``width``-word
    window that occurs in a text of ``reference`` (column ``text``), which may
    hold ``max_bytes`` at most, as its automata are broadcast."""
    size = reference.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"the reference has {size} bytes; automata of at most {max_bytes} are broadcast")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in b["text"].cast(pa.binary()).to_pylist() if t]
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(SuffixAutomaton((t.split(), 0) for t in texts))], pa.binary())], ["shard"])

    built = reference.select("text").repartition(shards).mapInArrow(build, "shard binary").collect()
    shared = docs.sparkSession.sparkContext.broadcast([bytes(r["shard"]) for r in built])
    removal = _removal(width, with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [pickle.loads(x) for x in shared.value]
        for part in slices(batches):
            spans = []
            for raw in part["text"].cast(pa.binary()).to_pylist():
                words, items = raw.split(), []
                for automaton in automata:
                    marks = np.array(automaton.windows(words, width), np.int64)
                    if len(marks) and marks.min() < NEVER:
                        items.append({"p0": 0, "marks": np.where(marks < NEVER, -NEVER, NEVER).tobytes()})
                spans.append(items)
            kind = pa.list_(pa.struct([("p0", pa.int32()), ("marks", pa.binary())]))
            id_column = part["doc_id"].fill_null(0)
            marked_part = pa.RecordBatch.from_arrays([id_column, part["text"], pa.array(spans, kind)], ["doc_id", "text", "spans"])
            for done in removal(iter([marked_part])):
                yield done.set_column(0, "doc_id", part["doc_id"])

    return id_text(docs).mapInArrow(run, _schema(with_text))
