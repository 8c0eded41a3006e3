"""Exact and near duplicates, and the two removals, against brute force."""

import hashlib
import random
import re

import pytest

from threadweave.llm import anchored, substring_dedup
from threadweave.llm.exact_dedup import Directory, drop_copies, exact_duplicates
from threadweave.llm.near_dedup import NearRules, _tiles, keep_one, min_matches, near_duplicates
from threadweave.llm.substring_dedup import SuffixAutomaton, remove_reference_spans, remove_repeated_spans
from threadweave.llm.suffix_dedup import remove_repeats


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# ---------------------------------------------------------------- exact


def test_exact_groups(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "a  b", "a\n\tb", " a b", "a b ", "", "ab", f"only {i}"])) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "a b"), (None, "alone"), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = []
    for i, t in rows:
        own = groups[norm(t)]
        keep = min((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(tuple, exact_duplicates(df, capacity=4).collect()), key=str) == sorted(want, key=str)
    left = [r.doc_id for r in drop_copies(df).collect()]
    assert sorted(left, key=str) == sorted((x[0] for x in want if x[3] or x[0] is None), key=str)


def test_directory_splits_until_buckets_fit(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    d = Directory(keys, 40)
    assert d.bounds[0] == 0 and len(set(d.bounds)) == len(d.bounds)
    held = [r["count"] for r in d.assign(keys).groupBy("bucket").count().collect()]
    assert sum(held) == 5000 and max(held) <= 40
    assert all(d.bucket(r.key) == r.bucket for r in d.assign(keys).limit(200).collect())


def removal_brute(rows, groups):
    """Rows that stay: ``groups`` maps a row number to the smallest id of its group."""
    return sorted(((i, t) for k, (i, t) in enumerate(rows) if i is None or i == groups[k]), key=str)


REPEATED = [(1, "the same words stand here"), (5, "the same words stand here"), (5, "only here are these other words found"),
            (7, "the same words stand here"), (7, None), (None, "the same words stand here"), (9, "only here are these other words found"),
            (9, "a third text of its own"), (9, "a third text of its own"), (2, "")]


def test_removals_with_repeated_ids(spark):
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(REPEATED)], "doc_id long, text string, gone_id long").repartition(4)
    by_text = {}
    for i, t in REPEATED:
        if i is not None:
            by_text[t or ""] = min(i, by_text.get(t or "", i))
    want = removal_brute(REPEATED, [by_text[t or ""] for _, t in REPEATED])
    assert (1, REPEATED[0][1]) in want and (5, REPEATED[2][1]) in want and (9, REPEATED[7][1]) in want
    assert sorted(((r.doc_id, r.text) for r in drop_copies(df).collect()), key=str) == want
    # in near duplicates a text without words is linked with nothing, so each stays
    near = removal_brute(REPEATED, [by_text[t] if t else i for i, t in REPEATED])
    assert sorted(((r.doc_id, r.text) for r in keep_one(df).collect()), key=str) == near


def test_near_rows_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame(REPEATED + [(None, "nobody has an id here"), (None, "nobody has an id here")], "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (5, 1, False), (5, 5, True), (7, 1, False), (7, 7, True), (None, 1, False), (9, 5, False), (9, 9, True),
                          (9, 9, True), (2, 2, True), (None, None, True), (None, None, True)], key=str)


# ---------------------------------------------------------------- near


def near_brute(rows, rules):
    sets = {}
    for i, t in rows:
        w, k = low(t).encode().split(), rules.shingle
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            same = len(sets[a] & sets[b])
            if same and rules.den * same >= rules.num * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def near_rows():
    rng = random.Random(1)
    vocabulary, rows = [f"w{i}" for i in range(3000)], []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(2, 250))]
        for _ in range(rng.choice([1, 2, 3, 40])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    n = len(rows)
    return rows + [(n, ""), (n + 1, None), (n + 2, "One"), (n + 3, "one"), (n + 4, "a b")]


@pytest.mark.parametrize("rules", [NearRules(shingle=3, num=85, den=100), NearRules(shingle=3, num=85, den=100, star_rounds=1, block=16)])
def test_near_components_equal_brute_force(spark, rules):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, rules).collect()}
    assert got == near_brute(rows, rules)


def test_tiles_are_bounded_and_meet_every_probe_once(spark):
    # a hot band of probes: 1 main member in 10, all others in components of their own
    size, main = 1200, 120
    rows = [(5, i, 0 if i < main else i, 0, size, size - main) for i in range(size)]
    df = spark.createDataFrame(rows, "band long, rep long, comp long, main long, size long, probes long")
    tiles = {}
    for r in _tiles(df, NearRules(block=64)).collect():
        tiles.setdefault((r.pb, r.hb), []).append(r)
    assert max(map(len, tiles.values())) <= 3 * 64  # two blocks, dealt by a hash
    met = [(a.rep, b.rep) for x in tiles.values() for a in x if a.probe for b in x if b.home]
    assert len(met) == len(set(met)) == (size - main) * size


def test_near_hot_band_of_probes_equals_brute_force(spark):
    # pages of one template that share bands and are no near duplicates, with some true pairs
    rng = random.Random(3)
    template = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = [f"p{i}x{j}" for j in range(22)]
        rows.append((i, " ".join(template + own)))
        if i % 10 == 0:
            own[rng.randrange(22)] = "changed"
            rows.append((1000 + i, " ".join(template + own)))
    rules = NearRules(shingle=3, num=85, den=100, block=16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, rules).collect()}
    want = near_brute(rows, rules)
    assert got == want and sum(not x[2] for x in want.values()) == 15


def test_near_chain_is_one_component(spark):
    # each text is close to the next, the ends are far apart
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[10 * i:10 * i + 200])) for i in range(20)]
    rules = NearRules(shingle=3, num=85, den=100)
    got = {r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rules).collect()}
    assert got == {0} == {x[1] for x in near_brute(rows, rules).values()}


def test_pruning_keeps_pairs_above_the_threshold():
    rules = NearRules()
    for n, least in min_matches(rules):
        assert 0 < least < n * rules.num / rules.den
    assert [m for _, m in min_matches(rules)] == sorted(m for _, m in min_matches(rules))


def test_keep_one_of_each_group(spark):
    rows = near_rows()
    rules = NearRules(shingle=3, num=85, den=100)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, "x", 2)], "doc_id long, text string, gone_id int")
    assert {r.doc_id for r in keep_one(df, rules).collect()} == {i for i, x in near_brute(rows, rules).items() if x[2]} | {None}


# ---------------------------------------------------------------- removals


def removed_bytes(rows, width):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            seen[b[p:p + width]] = seen.get(b[p:p + width], 0) + 1
    out = []
    for i, t in rows:
        b, gone, upto = (t or "").encode(), bytearray(len((t or "").encode())), 0
        for p in range(len(b) - width + 1):
            if seen[b[p:p + width]] > 1:
                for j in range(max(p, upto), p + width):
                    gone[j] = 1
                upto = p + width
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def removed_words(rows, width):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - width + 1):
            if i is not None:
                first[tuple(w[p:p + width])] = min(first.get(tuple(w[p:p + width]), i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if i is not None and first[tuple(w[p:p + width])] < i:
                gone[p:p + width] = [True] * width
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(2)
    vocabulary = ["the", "of", "and", "é"] + [f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 120))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))))
            if rng.random() < 0.2:
                parts.append(parts[-1])
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    return rows + [(200, None), (201, ""), (202, "a" * 900), (203, "b" * 150 + "a" * 300), (3, rows[3][1]), (None, rows[5][1]), (None, None),
                   (300, shared[0] * 3)]


@pytest.mark.parametrize("hot", [50_000, 2])
def test_removals_equal_brute_force(spark, passages, hot, monkeypatch):
    plain = anchored.Windows.__init__.__defaults__
    monkeypatch.setattr(anchored.Windows.__init__, "__defaults__", (hot, 1000 if hot == 2 else plain[1]))
    df = spark.createDataFrame(passages, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, remove_repeats(df).collect()), key=str) == removed_bytes(passages, 200)
    assert sorted(map(tuple, remove_repeated_spans(df).collect()), key=str) == removed_words(passages, 13)


def test_automaton_windows():
    rng = random.Random(6)
    texts = [([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))], i) for i in range(30)]
    automaton = SuffixAutomaton(texts)
    for width in (1, 3, 6):
        first = {}
        for w, i in texts:
            for p in range(len(w) - width + 1):
                first[tuple(w[p:p + width])] = min(first.get(tuple(w[p:p + width]), i), i)
        query = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(300)]
        got = automaton.windows(query, width)
        assert got == [first.get(tuple(query[p:p + width]), (1 << 63) - 1) for p in range(len(query) - width + 1)]


def anchored_strings(rng, sizes, vocabulary):
    """Distinct strings of anchors 1, 2, ... as the solver gets them: 5 windows of 13 words; every third string without a document."""
    rows = []
    for g, n in enumerate(sizes, 1):
        for i in range(n):
            words = [b"x%d" % rng.randrange(vocabulary) for _ in range(17)]
            at = rng.randint(4, 9)
            words[at:at + 4] = [b"anchor%d" % g] * 4
            rows.append([g, 5, at, b" ".join(words), 1 + i % 2, None if i % 3 == 2 else rng.randrange(10**6)])
    return anchored.Strings(rows)


def solved_brute(own, width):
    first = {}
    for body, least in zip(own.body, own.least, strict=True):
        words = body.split()
        for p in range(len(words) - width + 1):
            if least is not None:
                first[tuple(words[p:p + width])] = min(first.get(tuple(words[p:p + width]), least), least)
    return [[first.get(tuple(words[p:p + width]), substring_dedup.NEVER) for p in range(5)] for words in (b.split() for b in own.body)]


@pytest.mark.parametrize(("sizes", "vocabulary", "most"), [((21_000,), 9_000, None), ((1, 9, 2, 40, 3, 1, 5), 2, 60), ((30, 30), 1, 1)])
def test_automata_of_large_anchors_are_bounded(monkeypatch, sizes, vocabulary, most):
    own, built = anchored_strings(random.Random(4), sizes, vocabulary), []

    class Counted(SuffixAutomaton):
        def __init__(self, passages):
            passages = list(passages)
            built.append(sum(len(w) for w, _ in passages))
            super().__init__(passages)

    monkeypatch.setattr(substring_dedup, "SuffixAutomaton", Counted)
    if most:
        monkeypatch.setattr(substring_dedup, "SHARD_WORDS", most)
    got = substring_dedup._solver(13)(own)
    assert len(built) > 1 and max(built) <= max(17, most or 200_000)   # before: one automaton of all words, 443 MB at 50,000 strings
    for i, (marks, want) in enumerate(zip(got, solved_brute(own, 13), strict=True)):
        if marks is not None:
            assert memoryview(marks).cast("q").tolist() == want
        else:   # nothing smaller than its own document, which is its only one
            assert own.n[i] == 1 and min(want) >= (substring_dedup.NEVER if own.least[i] is None else own.least[i])


def test_reference_spans(spark):
    words = [f"w{i}" for i in range(100)]
    reference = spark.createDataFrame([(" ".join(words[:40]),), (" ".join(words[60:80]),), (None,), ("short",)], "text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(words[5:30]) + " y"), (2, " ".join(words[30:70])), (None, " ".join(words[60:75])), (4, None)],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_reference_spans(docs, reference, with_text=True).collect()}
    assert got == {1: (27, 25, "x y"), 2: (40, 0, " ".join(words[30:70])), None: (15, 15, ""), 4: (0, 0, "")}
    with pytest.raises(ValueError, match="broadcast"):
        remove_reference_spans(docs, reference, max_bytes=10)
