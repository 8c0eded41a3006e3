"""Packing: ids of the tokenizer, limits, full coverage and padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from threadweave.llm.packing import Limits, Packer, byte_bpe, pack_documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def checked(packer, lengths, runs, limits):
    covered, sequences = defaultdict(list), defaultdict(list)
    for q, offset, p in packer.done:
        sequences[q].append((offset, p))
        covered[p.row].append((p.start, p.length))
    for pieces in sequences.values():
        end = 0
        for offset, p in pieces:
            assert offset == end and p.length > 0
            assert p.loss == (p.length if runs is None else runs[p.row][p.start + p.length] - runs[p.row][p.start])
            end += p.length
        assert end <= limits.tokens and len(pieces) <= limits.segments and sum(p.loss for _, p in pieces) <= limits.loss
    for row, n in enumerate(lengths):
        end = 0
        for start, length in sorted(covered[row]):
            assert start == end
            end += length
        assert end == n
    return [sum(p.length for _, p in x) for x in sequences.values()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60), st.integers(1, 5), st.integers(20, 128), st.randoms())
def test_limits_hold_together(lengths, segments, loss, rng):
    limits = Limits(128, segments, loss)
    runs = [np.concatenate([[0], np.cumsum([rng.random() < 0.6 for _ in range(n)])]) for n in lengths]
    packer = Packer(limits, pool=8)
    for row, n in enumerate(lengths):
        packer.add(row, n, runs[row])
    packer.finish()
    checked(packer, lengths, runs, limits)


def test_no_padding_when_only_tokens_bind():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 4000, 500).tolist()
    packer = Packer(Limits())
    for row, n in enumerate(lengths):
        packer.add(row, n)
    packer.finish()
    sizes = checked(packer, lengths, None, Limits())
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes)
    assert sum(n < 1024 for n in sizes) <= 10


def test_ids_equal_the_tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " a  b\n\n c", "it's <|endoftext|> x", "日本語 é x  y", "1234 $$$ ##", "\x1c\x85 z"]
    encode = byte_bpe(RANKS)
    for x in texts:
        assert encode.encode(x, allowed_special={"<|endoftext|>"}) == t.encode(x, add_special_tokens=False).ids


def test_rows_of_the_query(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [(10_000, None), (10_001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in rows}
    got, sequences = defaultdict(list), defaultdict(list)
    for r in pack_documents(df, RANKS, with_ids=True).collect():
        assert r.ids == ids[r.doc_id][r.start:r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        assert sum(n for _, n in got[i]) == len(x) and len({s for s, _ in got[i]}) == len(got[i])
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding == 0


def padded_share(rows):
    """Share of places that padding takes; sequences at a power of two have none."""
    ends = defaultdict(int)
    for r in rows:
        ends[r.sequence_id] += r.length
    full = sum(n if n & (n - 1) == 0 else 1024 for n in ends.values())
    return (full - sum(ends.values())) / full


def test_short_texts_need_no_padding(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'a b c d' AS text")
    rows = pack_documents(df, RANKS).collect()
    assert sum(r.length for r in rows) == 100_000 and padded_share(rows) <= 0.02
    few = pack_documents(df.limit(3000), RANKS, Limits(segments=64)).collect()
    assert padded_share(few) == 0 and max(np.unique([r.sequence_id for r in few], return_counts=True)[1]) <= 64


def test_loss_spans_bind(spark):
    texts = [(i, "question " * 40 + "answer " * (i % 9), [(360, 360 + 7 * (i % 9))]) for i in range(200)] + [(500, None, None), (501, "x", None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, text_spans array<struct<begin:int,end:int>>")
    limits = Limits(tokens=256, loss=8)
    rows = pack_documents(df, RANKS, limits, loss_spans="text_spans", with_ids=True).collect()
    encode = byte_bpe(RANKS)
    loss, tokens, per_doc = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        loss[r.sequence_id] += r.loss_tokens
        tokens[r.sequence_id] += r.length
        per_doc[r.doc_id] += r.loss_tokens
    assert max(loss.values()) == 8 and max(tokens.values()) <= 256
    assert all(n & (n - 1) == 0 for n in tokens.values())
    without = pack_documents(df, RANKS, Limits(tokens=256, loss=256), loss_spans="text_spans").select("sequence_id").distinct().count()
    assert len(tokens) > without   # the limit, not the tokens, closes sequences
    for i, text, spans in texts:
        ids = encode.encode(text or "")
        _, at = encode.decode_with_offsets(ids)
        covered = {k for b, e in spans or () for k in range(b, e)}
        assert per_doc[i] == sum(a in covered for a in at) + (bool(text) and len(text) - 1 in covered)
