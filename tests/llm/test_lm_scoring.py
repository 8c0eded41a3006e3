"""Language-model scores: base figures by brute force, a proper distribution,
gradients, each id scored once, and held-out likelihood."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from threadweave.llm.lm_scoring import (
    Attention, LmRules, Scorer, Shares, Subwords, Trainer, Weights, _learn, _merged, lm_scores, score_ids, windows)
from threadweave.llm.packing import byte_bpe
from threadweave.llm.textcols import MIX, mix, word_hashes, words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = LmRules()


@pytest.fixture(scope="module")
def vocabulary():
    return Subwords(RANKS, RULES)


def test_ids_are_those_of_the_words(vocabulary):
    rng = random.Random(8)
    texts = ["", "the cat's 12 é", "a", "x\xa0 \xa0y z\u2003 \x85", "--- === '' "]
    texts += ["".join(rng.choice("ab' .é\xa0\u3000\x1c\n日1-") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    ids, starts = vocabulary.of(words(pa.array(texts)))
    for i, t in enumerate(texts):
        want = [x for w in t.encode().split() for x in vocabulary.encode(" " + w.decode())] + [vocabulary.end]
        assert ids[starts[i]:starts[i + 1]].tolist() == want


def test_special_strings_are_text(vocabulary):
    for text in ("<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>\x85y"):
        ids, _ = vocabulary.of(words(pa.array([text])))
        assert ids.tolist() == [x for w in text.encode().split() for x in byte_bpe(RANKS).encode_ordinary(" " + w.decode())] + [vocabulary.end]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_word_hashes_of_long_words(kind):
    vocab = ["", "a", "\u00e9" * 16, "x" * 31, "y" * 32, "z" * 33, "\u65e5" * 500, "b" * 900]
    want = []
    for w in vocab:
        total = MIX.copy()
        with np.errstate(over="ignore"):
            for i, c in enumerate(w.encode()):
                total += mix(np.array([i * 256 + c + 1], np.uint64) * MIX)[0]
        want.append(int(mix(np.array([total]))[0]))
    for first in (0, 3):
        assert word_hashes(pa.array(vocab, kind)[first:]).tolist() == want[first:]
    assert len(word_hashes(pa.array([], kind))) == 0


def test_a_task_writes_the_count_of_a_word_once(spark):
    long = "one two three four " * 120_000  # two of these are more than a slice
    df = spark.createDataFrame([(long,)] * 3 + [("five one",)], "text string").coalesce(1)
    rows = [(r.key, r.n) for r in _learn(df, RANKS, LmRules()).filter("kind = 'word'").select("key", "n").collect()]
    want = dict(zip(word_hashes(pa.array(["one", "two", "three", "four", "five"])).view(np.int64).tolist(),
                    [360_001, 360_000, 360_000, 360_000, 1], strict=True))
    assert len(rows) == len(want) and dict(rows) == want


def test_merged_counts():
    low, high = -(1 << 63), (1 << 63) - 1
    key, n = _merged([(np.array([5, low, high]), np.array([1, 2, 3])), (np.array([], np.int64), np.array([], np.int64)),
                      (np.array([high, 5, -1]), np.array([10, 20, 30]))])
    assert dict(zip(key.tolist(), n.tolist(), strict=True)) == {low: 2, -1: 30, 5: 21, high: 13} and len(key) == 4
    assert len(_merged([(np.array([], np.int64), np.array([], np.int64))])[0]) == 0


def test_each_id_is_scored_once_with_context(vocabulary):
    s = 4
    ids, starts = np.arange(100, 123), np.array([0, 1, 10, 23])
    rows, target = windows(ids, starts, vocabulary, s)
    assert sorted(target[target >= 0].tolist()) == ids.tolist()
    assert len(rows) % s == 0
    at = np.flatnonzero(target >= 0)
    for k, i in enumerate(at):
        assert rows[i] == (vocabulary.start_row if k in starts else vocabulary.row[ids[k - 1]])


def test_probabilities_sum_to_one(vocabulary):
    rng = np.random.default_rng(0)
    v = vocabulary
    id_count, pair_count = rng.integers(0, 5, v.end + 1).astype(float), rng.integers(0, 3, v.slots ** 2).astype(float)
    shares = Shares(v, id_count, pair_count, 20.0)
    every = np.arange(v.end + 1)
    for before in (5, 40_000):
        slot = v.slot[before]
        p = (shares.pair[slot * v.slots + v.slot[every]] * shares.own + 20 * shares.share) / (shares.by_class[slot * v.classes + v.cls] + 20)
        assert np.allclose(np.bincount(v.cls, weights=p), 1, atol=1e-5)


def test_gradients(vocabulary):
    rules = LmRules(dim=4, stride=4)
    w = Weights.start(vocabulary, rules)
    for x in w.parts():
        x += np.random.default_rng(1).standard_normal(x.shape).astype(np.float32) * 0.1
    w = Weights(*(x.astype(np.float64) for x in w.parts()))
    net = Attention(w, vocabulary, 4)
    rng = np.random.default_rng(2)
    rows, target = rng.integers(0, 50, (3, 8)), rng.integers(0, 500, (3, 4))
    rows[0, :3], target[1, 2] = vocabulary.pad_row, -1

    def loss():
        logits, _ = net.forward(rows)
        log = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        i, j = np.nonzero(target >= 0)
        return -log[i, j, vocabulary.cls[target[i, j]]].mean()

    logits, kept = net.forward(rows)
    grads = net.backward(logits, kept, target)
    for x, g in zip(w.parts(), grads, strict=True):
        flat, flat_g = x.reshape(-1), np.asarray(g).reshape(-1)
        for i in np.argsort(-np.abs(flat_g))[:4].tolist():
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - flat_g[i]) < 2e-3 * max(1, abs(flat_g[i]))


def test_attention_does_not_look_ahead(vocabulary):
    w = Weights.start(vocabulary, RULES)
    net = Attention(w, vocabulary, RULES.stride)
    rows = np.random.default_rng(3).integers(0, 4000, (1, 32))
    before, _ = net.forward(rows)
    rows[0, 25] += 1
    after, _ = net.forward(rows)
    assert np.allclose(before[0, :9], after[0, :9], atol=1e-5) and not np.allclose(before[0, 9:], after[0, 9:], atol=1e-5)


def test_scorer_equals_the_forward_pass(vocabulary):
    w = Weights.start(vocabulary, RULES)
    w.dist += np.random.default_rng(1).standard_normal(w.dist.shape).astype(np.float32)
    s, rng = RULES.stride, np.random.default_rng(2)
    rows = rng.integers(0, 4000, (6, s))
    rows[0], rows[3, :5] = vocabulary.pad_row, vocabulary.pad_row
    cls = rng.integers(0, vocabulary.classes, 5 * s)
    logits, _ = Attention(w, vocabulary, s).forward(np.concatenate([rows[:-1], rows[1:]], axis=1))
    want = (logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))).reshape(5 * s, -1)[np.arange(5 * s), cls]
    assert np.allclose(Scorer(w, vocabulary, s).class_logs(rows, cls), want, atol=1e-4)


def test_a_step_has_the_gradients_of_all_its_windows(vocabulary):
    v, s = vocabulary, RULES.stride
    rng = np.random.default_rng(5)
    starts = np.concatenate([[0], np.cumsum([1, 16, 17, 300, 5, 90])])
    ids = rng.integers(0, 50_000, starts[-1])
    ids[starts[1:] - 1] = v.end
    rows, target = (x.reshape(-1, s) for x in windows(ids, starts, v, s))
    w = Weights.start(v, RULES)
    net = Attention(w, v, s)
    logits, kept = net.forward(np.concatenate([rows[:-1], rows[1:]], axis=1))
    grads = net.backward(logits, kept, target[1:])
    trainer = Trainer(Weights.start(v, RULES), v, RULES)
    trainer.step(rows, target[1:])
    for sq, g in zip(trainer.square, grads, strict=True):
        assert np.allclose(np.sqrt(sq), np.sqrt(g * g + 1e-6), atol=1e-5)
    for x, y, g in zip(trainer.w.parts(), w.parts(), grads, strict=True):
        assert np.allclose(x, y - RULES.rate * g / np.sqrt(g * g + np.float32(1e-6)), atol=1e-3)


def test_a_step_clips_large_logits(vocabulary):
    v, s = vocabulary, RULES.stride
    ids = np.append(np.random.default_rng(9).integers(0, 50_000, 200), v.end)
    rows, target = (x.reshape(-1, s) for x in windows(ids, np.array([0, 201]), v, s))
    steep = Weights.start(v, RULES)
    steep.out *= 120
    steep.wq *= 40
    net = Attention(steep, v, s)
    logits, kept = net.forward(np.concatenate([rows[:-1], rows[1:]], axis=1))
    assert logits.max() == 50 and logits.min() == -50
    grads = net.backward(logits, kept, target[1:])
    again = Weights.start(v, RULES)
    again.out *= 120
    again.wq *= 40
    trainer = Trainer(again, v, RULES)
    trainer.step(rows, target[1:])
    for sq, g in zip(trainer.square, grads, strict=True):
        assert np.allclose(np.sqrt(sq), np.sqrt(g * g + 1e-6), rtol=1e-2, atol=1e-3 * max(1, np.abs(g).max()))


def test_every_window_trains(vocabulary):
    v, s = vocabulary, RULES.stride
    sizes = [1, 7, 16, 17, 40, 500, 16, 2000]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.random.default_rng(6).integers(0, 50_000, starts[-1])
    trainer = Trainer(Weights.start(v, RULES), v, RULES)
    reached = []
    step = trainer.step
    trainer.step = lambda rows, target: (reached.append(target[target >= 0]), step(rows, target))
    trainer.learn(ids, starts)
    assert trainer.seen == sum(-(-n // s) for n in sizes)
    assert sorted(np.concatenate(reached).tolist()) == sorted(ids.tolist())


def test_short_texts_train_in_any_layout(vocabulary):
    v = vocabulary
    texts = [np.append(np.random.default_rng(i).integers(0, 50_000, i % 15), v.end) for i in range(40)]
    reached = []
    for size in (1, 7, 40):  # texts of a slice
        trainer, own = Trainer(Weights.start(v, RULES), v, RULES), []
        step = trainer.step
        trainer.step = lambda rows, target, own=own, step=step: (own.append(target[target >= 0]), step(rows, target))
        for i in range(0, len(texts), size):
            part = texts[i:i + size]
            trainer.learn(np.concatenate(part), np.concatenate([[0], np.cumsum([len(x) for x in part])]))
        assert trainer.seen == len(texts)  # one window each
        reached.append(sorted(np.concatenate(own).tolist()))
    assert reached[0] == reached[1] == reached[2] == sorted(np.concatenate(texts).tolist())


def test_training_helps_on_held_out_text(spark, vocabulary):
    texts = [r.text.lower() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(500).collect()]
    v = vocabulary
    ids, starts = v.of(words(pa.array(texts[:400])))
    new_ids, new_starts = v.of(words(pa.array(texts[400:])))
    shares = Shares(v, np.bincount(ids, minlength=v.end + 1).astype(float),
                    np.bincount(v.before(ids, starts) * v.slots + v.slot[ids], minlength=v.slots ** 2).astype(float), RULES.prior)
    trainer = Trainer(Weights.start(v, RULES), v, RULES)
    start = score_ids(new_ids, new_starts, v, Scorer(trainer.w, v, RULES.stride), shares).sum()
    for _ in range(2):
        trainer.learn(ids, starts)
    end = score_ids(new_ids, new_starts, v, Scorer(trainer.w, v, RULES.stride), shares).sum()
    kinds = np.bincount(v.cls[ids], minlength=v.classes) + 0.5
    unigram = (np.log10(kinds / kinds.sum())[v.cls[new_ids]]).sum() + shares.log(new_ids, new_starts).sum() / math.log(10)
    assert end > start and end > unigram


@pytest.mark.parametrize("frequent", [1_000_000, 16])
def test_base_scores(spark, frequent):
    rng = random.Random(4)
    vocabulary = [f"W{i}" for i in range(60)] + ["é", "the"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) + f" once{i}") for i in range(120)]
    rows += [(500, None), (501, ""), (3, rows[3][1]), (None, "the the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: [*(x.lower() for x in (t or "").encode().split()), None]
    count = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    total = sum(count.values())
    want = sorted(((i, held(i), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), total,
                    round(sum(math.log10((count[x] + 0.5) / (total + 0.5 * (len(count) + 1))) for x in tokens(t)), 6)) for i, t in rows), key=str)
    got = lm_scores(df, RANKS, rules=LmRules(frequent=frequent)).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == want
    assert all(r.score < 0 for r in got)
