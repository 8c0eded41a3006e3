"""Spelling variants, SimHash groups and conversation repair against brute force."""

import hashlib
import random
import re
from collections import Counter
from itertools import product
from zlib import crc32

import pytest
import xxhash

from threadweave.llm import spelling, turn_repair
from threadweave.llm.queries import ORACLE, QUERIES
from threadweave.llm.simhash import fingerprint, near_fingerprints, simhash_groups
from threadweave.llm.spelling import agreeing, letter_groups, one_edit, spelling_variants
from threadweave.llm.tables import Workspace
from threadweave.llm.turn_repair import END, Repair, damage, repair_turns, shifted
from tests.conftest import SF_SMALL
from tools.oracle_check import digest, duck

SPACE = " \t\n\x0b\x0c\r"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("key", ["op11_spelling_variants", "op13_turn_repair"])
def test_equals_the_sql(spark, key):
    df, rel = QUERIES[key](spark, SF_SMALL), duck(SF_SMALL).sql(ORACLE[key])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


# ---------------------------------------------------------------- spelling


def variants_brute(docs):
    counts = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    form, out = {}, []
    for w, n in counts.items():
        others = sorted((x for x in counts if near(w, x)), key=lambda x: (-counts[x], x))
        form[w] = (len(others), others[0] if others and counts[others[0]] >= 2 * n else None)
    for w, (k, f) in form.items():
        root = w
        while form[root][1]:
            root = form[root][1]
        out.append((w, counts[w], k, f, counts.get(f), root))
    return sorted(out, key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randint(5, 9))) for _ in range(25)] + ["aaaaaa", "x" * 60, "x" * 61, "y" + "x" * 60]

    def word():
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abÉ") + w[k:], w[:k] + rng.choice("abc") + w[k + 1:]])
        return w.upper() if rng.random() < 0.1 else w

    return [(i, rng.choice([" ", "-", "\n"]).join(word() for _ in range(rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("groups, tile", [(3, 5), (4, 4096), (5, 7), (6, 2)])
def test_variants_equal_brute_force(spark, groups, tile):
    docs = corpus(groups) + [(None, None), (None, "aaaaaa aaaaaa"), (5, ""), (5, "aaaaab aaaaab aaaaab")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = variants_brute(docs)
    assert any(r[3] for r in want) and any(r[3] and r[5] != r[3] for r in want) or groups == 3
    assert rows_of(spelling_variants(df, groups=groups, tile=tile)) == want


def test_variants_of_an_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n long")
    assert spelling_variants(empty).collect() == []
    docs = spark.createDataFrame([(i, "colour colours", "x", 1) for i in range(4)], "doc_id long, text string, word string, n long")
    got = {r.word: r for r in spelling_variants(docs).collect()}
    assert set(got) == {"colour", "colours"} and all(r.n_near == 1 and r.form is None and r.root == r.word for r in got.values())


def test_every_edit_leaves_a_choice_of_groups_alike():
    for groups in (3, 4, 5, 6):
        choices, cover = agreeing(groups)
        for a, b in product(range(groups), repeat=2):
            assert any(a not in c and b not in c for c in choices)
        assert all(any(g not in choices[c] for c in cover) for g in range(groups))
    of = letter_groups({"e": 10, "a": 9, "b": 1}, 3)
    assert len(of) == len(spelling.LETTERS) and set(of) == {0, 1, 2} and of[0] != of[4]


def test_one_edit():
    assert one_edit("abc", "abd") and one_edit("ab", "abc") and one_edit("ab", "xab") and one_edit("", "a")
    assert not one_edit("abc", "abc") and not one_edit("abc", "acb") and not one_edit("ab", "cad")


# ---------------------------------------------------------------- simhash


def simhash_brute(text, k=3):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return 0
    pieces = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_brute(points):
    """Smallest member of each point's component at two or fewer differing bits."""
    up = {p: p for p in points}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    points = sorted(points)
    for i, a in enumerate(points):
        for b in points[:i]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {p: find(p) for p in points}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_xxhash_is_sparks(spark):
    words = ["a b c", "é", "", "x" * 40]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("xxhash64(w)").collect()]
    assert got == [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]


@pytest.mark.parametrize("bucket", [1, 4, 128])
def test_linked_fingerprints_equal_brute_force(spark, bucket):
    rng = random.Random(bucket)
    points = {0, 1, 3, 7, 1 << 63, (1 << 32) - 1, (1 << 31) | (1 << 32)}
    for _ in range(12):  # clusters around a centre, some with one half in common
        c = rng.getrandbits(64)
        points.add(c)
        for _ in range(40):
            x = c
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.choice([rng.randrange(64), rng.randrange(32), 32 + rng.randrange(32)])
            points.add(x)
    fps = spark.createDataFrame([(signed(p),) for p in points], "fp long").repartition(4)
    links, _ = near_fingerprints(fps, Workspace(spark, "t-simhash"), bucket)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2 and a != b for a, b in pairs)
    up = {signed(p): signed(p) for p in points}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    want = groups_brute(up)
    assert {p: find(p) for p in up} == want and len(set(want.values())) < len(want)


@pytest.mark.parametrize("bucket", [2, 128])
def test_simhash_groups_equal_brute_force(spark, bucket):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcde ") for _ in range(400)) for _ in range(8)]
    docs = [(i, base[i % 8][:rng.randint(380, 400)] + rng.choice(["", " Z", " q r"])) for i in range(160)]
    docs += [(500, None), (501, ""), (502, " \t"), (503, "A b"), (504, "a  b"), (None, "a b"), (None, "nobody else"), (9, "twice"), (9, "other")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, fp string").repartition(5)
    fp = [simhash_brute(t) for _, t in docs]
    comp = groups_brute(set(fp))
    first = {}
    for (i, _), f in zip(docs, fp, strict=True):
        if i is not None:
            first[comp[f]] = min(i, first.get(comp[f], i))
    want = sorted(((i, f"{f:016x}", first.get(comp[f])) for (i, _), f in zip(docs, fp, strict=True)), key=str)
    assert rows_of(simhash_groups(df, shingle=3, bucket=bucket)) == want
    assert simhash_groups(df.limit(0), shingle=3).collect() == []


def test_fingerprint_in_chunks(monkeypatch):
    from threadweave.llm import simhash
    text = " ".join(f"w{i % 700}" for i in range(3000))
    whole = fingerprint(text, 3)
    monkeypatch.setattr(simhash, "CHUNK", 37)
    assert fingerprint(text, 3) == whole == signed(simhash_brute(text))


# ---------------------------------------------------------------- conversations


def test_automaton_knows_the_grammar():
    def accepts(text):
        stacks = [turn_repair.BOTTOM]
        for symbol in text:
            stacks = [after for s in stacks for after in shifted(s, symbol)]
        return any(shifted(s, END) for s in stacks)

    for n in range(7):
        for text in map("".join, product("sua", repeat=n)):
            assert accepts(text) == bool(re.fullmatch("(s?(ua)+)?", text)), text


def repair_brute(turns):
    """All of the contract by whole strings: every path's (cost, audit, roles, lines)."""
    zero = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "text": ""}
    if not turns:
        return zero
    numbers = [t for t, _, _ in turns if t is not None]
    out = zero | {"gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0}
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    paths = {"": (0, "", ())}  # by last role initial

    def better(found, state, new):
        if state not in found or new[:2] < found[state][:2]:
            found[state] = new

    def inserted(paths):
        found = {}
        todo = list(paths.items())
        for _ in range(3):
            nxt = []
            for state, p in todo:
                better(found, state, p)
                nxt += [(r, (p[0] + 5, p[1] + "I", (*p[2], name + ":"))) for r, name in (("u", "user"), ("a", "assistant")) if r in allowed[state]]
            todo = nxt
        return found

    seen = set()
    for _, role, text in turns:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            out[fault] += 1
        found = {}
        for state, (cost, audit, lines) in inserted(paths).items():
            better(found, state, (cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                if role[:1] and role[:1] in allowed[state]:
                    better(found, role[:1], (cost + late, audit + "K", (*lines, f"{role}:{text}")))
                for r, name in (("u", "user"), ("a", "assistant")):
                    if r in allowed[state]:
                        better(found, r, (cost + 1 + late, audit + "R", (*lines, f"{name}:{text}")))
        paths = found
    ends = inserted(paths)
    cost, audit, lines = min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])
    return out | {"cost": cost, "audit": audit, "text": "\n".join(lines)}


def random_turns(rng, n):
    turns = sorted(((rng.choice([None, *range(n)]), rng.choice(["user", "assistant", "system", "user", "assistant", " ", "", "tool", "u"]),
                     rng.choice(["Yes.", "No!", "cut", "", " \n", "Yes. ", "Why?\t", "é."])) for _ in range(n)),
                   key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    return turns


@pytest.mark.parametrize("block", [1, 200, 1 << 20])
def test_repair_equals_brute_force(block):
    rng = random.Random(block)
    for k in range(1500):
        turns = random_turns(rng, rng.randint(0, 9) if k else 400)
        repair = Repair(block)
        for t in turns:
            repair.add(*t)
        want = repair_brute(turns)
        want["repaired_sha256"] = hashlib.sha256(want.pop("text").encode()).hexdigest()
        assert repair.result() == want, turns


def test_few_stacks_and_few_frontiers():
    rng, f, seen = random.Random(5), turn_repair.START, set()
    for _ in range(20000):
        f, more, steps = turn_repair.advance(f, rng.choice(["s", "u", "a", ""]), rng.choice(["", "", "blank", "truncated"]))
        assert len(f) == len(steps) <= 12 and min(c for _, c in f) == 0 and max(c for _, c in f) <= turn_repair.SLACK and more >= 0
        seen.add(f)
    assert len(seen) < 4000


def test_repair_of_odd_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (1, 1, "assistant", "Ho."), (2, None, None, None), (2, 3, "user", "Go."),
            (None, 0, "system", "Be kind."), (None, 1, "user", "So?"), (3, 5, "assistant", "Late.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(4)
    got = {r.conv_id: r for r in repair_turns(df).collect()}
    assert set(got) == {1, 2, 3, None}
    assert (got[1].audit, got[1].duplicate, got[1].cost) == ("KKD", 1, 2)
    assert (got[2].audit, got[2].blank, got[2].gaps, got[2].illegal) == ("DD", 1, 0, 1)
    assert (got[None].audit, got[None].cost) == ("RR", 2)   # two changes of role cost less than two deletions
    assert got[3].audit == "D" and got[3].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair_turns(df.limit(0)).collect() == []
    hurt = {(r.conv_id, r.turn, r.copies) for r in damage(df).collect()}
    for conv, turn, _, _ in rows:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        assert (conv, turn, {0: 0, 3: 2}.get(kind, 1)) in hurt
