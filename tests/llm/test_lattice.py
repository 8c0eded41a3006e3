"""Token counts against the unigram tokenizer; sampled segmentations against
exact probabilities and exact round trips."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from threadweave.llm.piece_sampling import decode, decode_pieces, sample, sample_pieces
from threadweave.llm.pieces import pieces, units
from threadweave.llm.textcols import sums
from threadweave.llm.token_counts import best_counts, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a  b ", "The quick brown fox.\nIt jumps.", "日本語 xx\n\nyé€ 𝄞𝄞 x", "aaaaaaaaaaaaaaaaaaaaaaaaaa" * 20, "\t\tq",
         "unbelievable tokenization      of      runs", "Größe straße ñandú", "0123456789 3.14159"]


@pytest.fixture(scope="module")
def unigram():
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    t = Tokenizer(models.Unigram([(m.id_to_piece(i), m.get_score(i)) for i in range(m.vocab_size())], 0, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="never", split=False)
    return lambda text: len(t.encode(" " + text).ids) if text else 0  # the model's own rule: one space in front


def counts(texts):
    u = units(pa.array(texts))
    return sums(best_counts(pieces(MODEL), u)[1][u.codes], u.starts).tolist()


def test_counts_equal_the_tokenizer(unigram):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("aeiou thns.é日\n") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    assert counts(texts) == [unigram(x) for x in texts]


def test_counts_equal_the_tokenizer_on_documents(spark, unigram):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in token_counts(spark.createDataFrame(rows), MODEL).collect()}
    assert got == {r.doc_id: unigram(r.text) for r in rows}


def test_round_trip_keeps_every_byte():
    texts = [*TEXTS, "▁literal ▁▁ sign ▁", " nbsp   \x00\x7f"]
    u = units(pa.array(texts))
    ids, starts = sample(pieces(MODEL), u, np.arange(len(texts), dtype=np.uint64), 0.001, 9)
    assert decode(pieces(MODEL), ids, starts) == texts


def test_sample_is_distributed_as_the_lattice():
    p, n = pieces(MODEL), 60_000
    ids, starts = sample(p, units(pa.array(["there"] * n)), np.arange(n, dtype=np.uint64), 0.0005, 3)
    seen = Counter(tuple(ids[i:j].tolist()) for i, j in zip(starts[:-1], starts[1:], strict=True))
    number = {raw: i for i, raw in enumerate(p.raw) if raw and not p.byte_id.__contains__(i)}
    text, weights = b"\xffthere", {}

    def walk(at, done, score):
        if at == len(text):
            weights[tuple(done)] = math.exp(0.0005 * score)
        for end in range(at + 1, len(text) + 1):
            i = number.get(text[at:end])
            if i is not None:
                walk(end, [*done, i], score + p.score[i])

    walk(0, [], 0.0)
    total = sum(weights.values())
    assert set(seen) <= set(weights)
    for k, w in weights.items():
        assert abs(seen[k] / n - w / total) < 5 * math.sqrt(w / total / n) + 1e-4


def test_rows_get_the_same_ids_however_they_are_dealt(spark):
    rows = [(i, f"some words to be cut {i % 7}") for i in range(200)] + [(None, "no key"), (5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r.doc_id: r.ids for r in sample_pieces(df.repartition(1), MODEL).collect()}
    many = {r.doc_id: r.ids for r in sample_pieces(df.repartition(7), MODEL).collect()}
    other = {r.doc_id: r.ids for r in sample_pieces(df, MODEL, seed=2).collect()}
    assert one == many != other
    assert one[5000] == []
    back = {r.doc_id: r.text for r in decode_pieces(sample_pieces(df, MODEL), MODEL).collect()}
    assert back == {i: t or "" for i, t in rows}


def test_shares_rise_to_one_at_every_node():
    from threadweave.llm.piece_sampling import NO_ARC, Filtered

    f = Filtered(pieces(MODEL), units(pa.array([*TEXTS[:-1], "a" + " " * 9 + "b", "x\ny"])), 0.001)
    piece, share = np.stack(f.piece), np.stack(f.share)
    real = piece != NO_ARC
    assert (real[1:] <= real[:-1]).all()  # a node's arcs fill its ranks from the first
    assert (np.diff(share, axis=0)[real[1:]] >= 0).all()
    last = real.sum(axis=0) - 1
    assert (share[last[last >= 0], np.flatnonzero(last >= 0)] == 1).all()
