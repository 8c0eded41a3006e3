"""Secret scan: trigram queries, and spans against plain expressions."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from threadweave.llm.secret_scan import RULES, Rule, _finder, mask_secrets, scan_secrets, trigram_query


def plain(text, rules=RULES):
    return sorted((m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer(r.pattern, text)
                  if m.end(r.group) - m.start(r.group) >= r.min_len)


def holds(query, text):
    if query is True:
        return True
    if isinstance(query, bytes):
        return query in text.lower().encode()
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])


def test_queries():
    assert trigram_query("abcd") == ("and", frozenset({b"abc", b"bcd"}))
    assert trigram_query("abc|xyz") == ("or", frozenset({b"abc", b"xyz"}))
    assert trigram_query("[0-9a-f]+") is True
    assert trigram_query("a?bcd") == b"bcd" or trigram_query("a?bcd") == ("or", frozenset({("and", frozenset({b"abc", b"bcd"})), b"bcd"}))
    assert trigram_query("(?:foo)+x*") == b"foo"
    assert trigram_query(".*") is True


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(["password", "ToKeN", "api_key", "apikey", "AKIA", "deadbeef" * 3, "ghp_", "xoxb-", "://", "-----BEGIN RSA PRIVATE KEY-----"]),
       st.text(alphabet="aB3_-=:\"' /@.+é", max_size=30), st.text(alphabet="AKIab0123456789_", max_size=40))
def test_every_match_satisfies_its_query(word, middle, end):
    text = word + middle + end
    for r in RULES:
        if re.search(r.pattern, text):
            assert holds(trigram_query(r.pattern), text)


TEXTS = ["", "token: secret=abcdef12", "PASSWORD = 'hunter2hunter2' and api-key: x", "é AKIA" + "A1" * 10 + " " + "0f" * 14, "apikey=short",
         "see https://bob:hunter22@example.org/x", "ghp_" + "a1B2" * 10, "-----BEGIN RSA PRIVATE KEY-----", "x" * 70_000 + " token=abcdefgh",
         "ſecret=abcdefgh"]


def test_spans_and_masks(spark):
    rows = [*enumerate(TEXTS), (100, None), (None, TEXTS[1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    names = [r.kind for r in RULES]
    for r in scan_secrets(df).collect():
        text = dict(rows)[r.doc_id] or ""
        want = plain(text)
        assert r.spans == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        base = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want if RULES[k].base)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(names[k] == n for _, k, _ in want) for n in ("assign", "access", "hex"))
    masked = {r.doc_id: r.text for r in mask_secrets(df).collect()}
    assert masked[100] is None and masked[1] == "<secret>" and masked[5] == "see <secret>example.org/x"
    assert mask_secrets(df).columns == df.columns


def test_index_is_used_block_by_block():
    import pyarrow as pa

    rules = (Rule("a", "needle[0-9]"), Rule("b", "[xyz]{3,}"))
    texts = ["no", "needle1 xyzz", "need", "le1", "Needle2 needle3"]
    assert _finder(rules)(pa.array(texts)) == [plain(t, rules) for t in texts]
