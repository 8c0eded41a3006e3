"""Quality rules against a quadratic brute force."""

import random
from collections import Counter

import pyarrow as pa

from threadweave.llm.quality_rules import RepetitionRules, judge, keep_good, quality_rules

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")


def brute(text, least=10):
    ws = text.encode().split()
    n = len(ws)
    windows = Counter(tuple(ws[i:i + 3]) for i in range(n - 2))
    small = {j for i in range(n - 2) if windows[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and ws[i + k] == ws[j + k]:
                k += 1
            longest[i] = max(longest[i], k)
    large = {j for i in range(n) if longest[i] >= least for j in range(i, i + longest[i])}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (n, sum(len(x.decode()) for x in ws), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(small), len(large),
            max((x for x in longest if x >= least), default=0))


def test_counts_equal_brute_force():
    rng = random.Random(3)
    texts = ["", " \n\t", "é a\x1cb c", "x " * 70] + [" ".join(rng.choice(["a", "b", "é#", "d\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    got = judge(pa.array(texts), RepetitionRules())
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in COLUMNS) == brute(t), t


def test_verdict_limits(spark):
    rng = random.Random(4)
    fresh = lambda n: " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))
    block = fresh(40)
    rows = [(1, fresh(200)), (2, fresh(49)), (3, fresh(50)), (4, fresh(60) + " " + block + " " + block),
            (5, fresh(900) + " " + block + " " + fresh(5) + " " + block), (6, "same words here " * 100), (7, None), (None, fresh(80))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules(df).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (False, True), 4: (True, False), 5: (False, True), 6: (True, False),
                   7: (True, False), None: (False, True)}
    assert {r.doc_id for r in keep_good(df).collect()} == {1, 3, 5, None}
    strict = RepetitionRules(max_covered=0.05)
    assert {r.doc_id for r in keep_good(df, strict).collect()} == {1, 3, None}
