"""A piece vocabulary, its Aho-Corasick automaton, and the lattice units of texts.

The vocabulary is a SentencePiece model file's pieces with their scores, read
as a unigram vocabulary.  Spaces are the byte 0xFF here (it never occurs in
UTF-8, so a literal U+2581 in a text stays apart from them).  A text gets one
space in front; no piece has a space after another character, so every
segmentation has a boundary before each run of spaces.  The lattice therefore
falls into *units* - a run of spaces and the characters up to the next - and
equal units share their result."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = 0xFF
UNKNOWN_PENALTY = 10.0  # below the smallest score, for a character that no piece covers alone


class Pieces:
    """Vocabulary and automaton tables.

    ``goto[state, byte]``: next state.  ``piece[state]``: the longest piece
    ending there, or -1; ``shorter[state]``: the state of the next shorter one,
    or 0.  ``byte_id[b]``: id of the byte piece for b."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.vocab_size()
        self.score = np.array([model.get_score(i) for i in range(n)])
        self.byte_id = np.full(256, -1, np.int32)
        self.raw: list[bytes] = [b""] * n
        plain = []
        for i in range(n):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(text[3:5], 16)] = i
                self.raw[i] = bytes([int(text[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.raw[i] = text.encode().replace("▁".encode(), bytes([SPACE]))
                plain.append(i)
        if any(SPACE in self.raw[i].lstrip(bytes([SPACE])) for i in plain):
            raise ValueError("a piece has a space after another character: texts don't fall into units")
        self.length = np.array([len(x) for x in self.raw], np.int64)
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.flat_at = np.cumsum(self.length) - self.length
        self.unknown = float(self.score[plain].min()) - UNKNOWN_PENALTY
        self._automaton(plain)

    def _automaton(self, plain: list[int]) -> None:
        children: list[dict[int, int]] = [{}]
        end = [-1]
        for i in plain:
            s = 0
            for b in self.raw[i]:
                t = children[s].get(b)
                if t is None:
                    t = children[s][b] = len(children)
                    children.append({})
                    end.append(-1)
                s = t
            end[s] = i
        goto = np.zeros((len(children), 256), np.int32)
        self.piece, self.shorter = np.array(end, np.int32), np.zeros(len(children), np.int32)
        fail = [0] * len(children)
        queue = [0]
        for s in queue:
            if s:
                goto[s] = goto[fail[s]]
            for b, t in children[s].items():
                fail[t] = int(goto[fail[s], b]) if s else 0
                goto[s, b] = t
                f = fail[t]
                self.shorter[t] = f if end[f] >= 0 else self.shorter[f]
                queue.append(t)
        # a state without an own piece stands for the next shorter one
        none = self.piece < 0
        self.first = np.where(none, self.shorter, np.arange(len(end))).astype(np.int32)
        self.goto = goto


@lru_cache(maxsize=1)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


class Units(NamedTuple):
    """``codes[starts[i]:starts[i + 1]]`` are text i's units as indices into
    the distinct units, whose bytes are ``data[begin[u]:begin[u + 1]]``."""

    codes: np.ndarray
    starts: np.ndarray
    data: np.ndarray
    begin: np.ndarray


def units(texts: pa.Array) -> Units:
    raw = [b" " + x if x else b"" for x in texts.cast(pa.binary()).to_pylist()]
    data = np.frombuffer(b"".join(raw), np.uint8).copy()
    data[data == 0x20] = SPACE
    text_at = np.concatenate([[0], np.cumsum([len(x) for x in raw], dtype=np.int64)])
    head = data == SPACE
    run_on = np.concatenate([[False], head[:-1]])[: len(head)]
    inside = text_at[:-1][np.diff(text_at) > 0]
    run_on[inside] = False
    at = np.flatnonzero(head & ~run_on)
    offsets = np.concatenate([at, [len(data)]]).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    own = coded.dictionary
    begin = np.concatenate([[0], np.cumsum([len(x) for x in own.to_pylist()], dtype=np.int64)])
    return Units(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(at, text_at),
                 np.frombuffer(b"".join(own.to_pylist()), np.uint8), begin)


class Arcs(NamedTuple):
    """Lattice arcs, at most one into each node: the node's place in the step's
    ``nodes``, the node where the arc starts, piece id (-1: an unknown
    character), score."""

    at: np.ndarray
    source: np.ndarray
    piece: np.ndarray
    score: np.ndarray


def lattice_steps(p: Pieces, u: Units):
    """Walk all distinct units abreast, byte by byte, and yield for each end
    position the nodes reached and their arcs by falling length (longest piece
    first, unknown character last).

    Unit k has nodes ``u.begin[k] + k ... u.begin[k + 1] + k``, one more than bytes."""
    size = np.diff(u.begin)
    order = np.argsort(-size, kind="stable")
    begin, size = u.begin[:-1][order], size[order]
    node0 = begin + order
    state = np.zeros(len(order), np.int32)
    char = np.zeros(len(order), np.int64)  # where the current character begins
    live = len(order)
    for at in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size[:live], -at, side="left"))  # units longer than ``at``
        state[:live] = p.goto[state[:live], u.data[begin[:live] + at]]
        whole = size[:live] == at + 1
        more = np.flatnonzero(~whole)
        whole[more] = (u.data[begin[more] + at + 1] & 0xC0) != 0x80
        here = np.flatnonzero(whole)
        if not len(here):
            continue
        nodes = node0[here] + at + 1
        chain, place, single = [], np.arange(len(here)), np.zeros(len(here), bool)
        width = at + 1 - char[here]
        s = p.first[state[here]]
        while True:
            ok = s > 0
            place, s = place[ok], s[ok]
            if not len(place):
                break
            piece = p.piece[s]
            length = p.length[piece]
            single[place[length == width[place]]] = True
            chain.append(Arcs(place, nodes[place] - length, piece, p.score[piece]))
            s = p.shorter[s]
        alone = np.flatnonzero(~single)
        if len(alone):
            chain.append(Arcs(alone, nodes[alone] - width[alone], np.full(len(alone), -1, np.int32), np.full(len(alone), p.unknown)))
        char[here] = at + 1
        yield nodes, chain
