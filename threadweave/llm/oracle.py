"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

#: CRC-32 of a text's UTF-8 bytes, from a table of 256 remainders (polynomial 0xEDB88320).
_CRC = """crc_table AS MATERIALIZED (
      SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
      FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def _crc(text: str) -> str:
    """CRC-32 of the SQL expression ``text``, with ``crc_table`` joined in."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * j + 1, 2))::BIGINT"
    steps = f"list_transform(range(octet_length(encode({text}))), lambda j: {byte})"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295)"


OP11 = rf"""
    WITH RECURSIVE {_CRC},
    runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
             FROM documents),
    kinds AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 5 GROUP BY ALL),
    hashed AS (SELECT run, k, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM kinds, crc_table),
    cut AS (SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
    words AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
    holes AS MATERIALIZED (SELECT word, n, gap, substr(word, 1, gap - 1) || substr(word, gap + 1) AS rest
              FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS gap FROM words)),
    pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.rest = b.rest AND a.gap = b.gap AND a.word <> b.word
              UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
              UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
    best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM pairs GROUP BY word),
    forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.m >= 2 * w.n THEN
              (SELECT min(p.other) FROM pairs p WHERE p.word = w.word AND p.m = b.m) END AS form,
              CASE WHEN b.m >= 2 * w.n THEN b.m END::BIGINT AS form_n
              FROM words w LEFT JOIN best b USING (word)),
    chain AS (SELECT word, word AS root, form AS ahead FROM forms
              UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead)
    SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM forms f JOIN chain c ON c.word = f.word AND c.ahead IS NULL"""

#: States of the role grammar: 0 nothing, 1 after s, 2 after u, 3 after a; a path is its cost, audit and roles.
OP13 = rf"""
    WITH RECURSIVE {_CRC},
    convs AS MATERIALIZED (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
    raw AS (SELECT v.c, t.turn, coalesce(t.role, ' ') AS role, coalesce(t.text, ' ') AS text,
                   {_crc("coalesce(t.conv_id::VARCHAR, ' ') || ':' || coalesce(t.turn::VARCHAR, ' ')")} % 20 AS kind
            FROM conversations t JOIN convs v ON v.conv_id IS NOT DISTINCT FROM t.conv_id, crc_table),
    damaged AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                       CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                       unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw),
    placed AS (SELECT c, turn, role, text, substr(role, 1, 1) AS first, row_number() OVER o AS k, lag(substr(role, 1, 1)) OVER o AS before
               FROM damaged WINDOW o AS (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy)),
    turns AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 THEN 'duplicate'
                      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
    insertions(state, reached, edits, roles) AS (VALUES (0, 0, '', ''), (0, 2, 'I', 'u'), (0, 3, 'II', 'ua'), (1, 1, '', ''), (1, 2, 'I', 'u'),
        (1, 3, 'II', 'ua'), (2, 2, '', ''), (2, 3, 'I', 'a'), (2, 2, 'II', 'au'), (3, 3, '', ''), (3, 2, 'I', 'u'), (3, 3, 'II', 'ua')),
    moves(reached, letter, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    path AS (
      SELECT c, 0::BIGINT AS k, 0 AS state, '0000000000||' AS best FROM convs
      UNION ALL
      SELECT c, k, state, min(printf('%010d', cost) || '|' || audit || '|' || roles) AS best FROM (
        SELECT p.c, t.k, e.after AS state, split_part(p.best, '|', 1)::BIGINT + 5 * length(i.edits) + e.cost AS cost,
               split_part(p.best, '|', 2) || i.edits || e.edit AS audit, split_part(p.best, '|', 3) || i.roles || e.role AS roles
        FROM path p JOIN turns t ON t.c = p.c AND t.k = p.k + 1 JOIN insertions i ON i.state = p.state,
        LATERAL (SELECT i.reached AS after, 2 AS cost, 'D' AS edit, '-' AS role
                 UNION ALL SELECT m.after, CASE t.fault WHEN 'truncated' THEN 5 ELSE 0 END + CASE WHEN m.letter = t.first THEN 0 ELSE 1 END,
                        CASE WHEN m.letter = t.first THEN 'K' ELSE 'R' END, m.letter
                 FROM moves m WHERE m.reached = i.reached AND t.fault NOT IN ('blank', 'duplicate')
                   AND (m.letter = t.first OR m.letter <> 's')) e)
      GROUP BY c, k, state),
    ended AS (
      SELECT p.c, min(printf('%010d', split_part(best, '|', 1)::BIGINT + 5 * length(i.edits)) || '|' || split_part(best, '|', 2) || i.edits
                      || '|' || split_part(best, '|', 3) || i.roles) AS best
      FROM path p JOIN (SELECT c, max(k) AS k FROM path GROUP BY c) USING (c, k) JOIN insertions i ON i.state = p.state AND i.reached IN (0, 3)
      GROUP BY p.c),
    edits AS (SELECT c, j, substr(split_part(best, '|', 2), j, 1) AS edit, substr(split_part(best, '|', 3), j, 1) AS role,
                     length(replace(substr(split_part(best, '|', 2), 1, j), 'I', '')) AS k
              FROM (SELECT c, best, unnest(range(1, length(split_part(best, '|', 2)) + 1)) AS j FROM ended)),
    repaired AS (SELECT e.c, string_agg(CASE e.edit WHEN 'K' THEN t.role WHEN 'R' THEN r.name ELSE r.name END || ':'
                                        || CASE e.edit WHEN 'I' THEN '' ELSE t.text END, chr(10) ORDER BY e.j) AS text
                 FROM edits e LEFT JOIN turns t ON t.c = e.c AND t.k = e.k LEFT JOIN (VALUES ('u', 'user'), ('a', 'assistant')) r(letter, name)
                   ON r.letter = e.role WHERE e.edit <> 'D' GROUP BY e.c),
    counted AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                       count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                       count(*) FILTER (before IS NOT NULL AND before || first NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY c)
    SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, split_part(best, '|', 1)::BIGINT AS cost,
           split_part(best, '|', 2) AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
    FROM convs v JOIN ended USING (c) LEFT JOIN counted USING (c) LEFT JOIN repaired r USING (c)"""

#: A word goes if one of the 13 windows that cover it starts in a document with a smaller id.
OP5 = r"""
    WITH lists AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(l[i:i + 12], ' ') AS words FROM (SELECT doc_id, l, unnest(range(1, len(l) - 11)) AS i FROM lists)),
    firsts AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY words),
    hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (words) WHERE first < doc_id),
    marked AS (SELECT w.doc_id, w.i, w.word, max(h.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS 12 PRECEDING) IS NOT NULL AS gone
               FROM (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS i FROM lists) w LEFT JOIN hits h ON h.doc_id = w.doc_id AND h.i = w.i),
    kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM marked GROUP BY doc_id)
    SELECT d.doc_id, len(d.l)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
    FROM lists d LEFT JOIN kept k USING (doc_id)"""

#: A byte goes if a 200-byte string that covers it starts at two places or more.
OP8 = r"""
    WITH texts AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    windows AS MATERIALIZED (SELECT doc_id, i, md5(b[i + 1:i + 200]) AS m FROM (SELECT doc_id, b, unnest(range(octet_length(b) - 199)) AS i FROM texts)),
    hits AS (SELECT doc_id, i FROM windows WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)),
    marked AS (SELECT t.doc_id, t.i, t.byte, max(h.i) OVER (PARTITION BY t.doc_id ORDER BY t.i ROWS 199 PRECEDING) IS NOT NULL AS gone
               FROM (SELECT doc_id, i, hex(b[i + 1:i + 1]) AS byte FROM (SELECT doc_id, b, unnest(range(octet_length(b))) AS i FROM texts)) t
               LEFT JOIN hits h ON h.doc_id = t.doc_id AND h.i = t.i),
    runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
    kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
                    string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS bytes FROM runs GROUP BY doc_id)
    SELECT t.doc_id, octet_length(t.b)::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed, coalesce(k.n_spans, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(k.bytes, ''))) AS kept_sha256
    FROM texts t LEFT JOIN kept k USING (doc_id)"""

OP10 = r"""
    WITH RECURSIVE lists AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x20\x09-\x0D]+') AS l FROM documents),
    shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(l[i:i + 2], ' ') AS s
                 FROM (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 1, least(len(l), 1) + 1))) AS i FROM lists) WHERE len(l) > 0),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
    ends AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT a, a AS b FROM ends UNION SELECT r.a, e.b FROM reach r JOIN ends e ON e.a = r.b),
    least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
           d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
    FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least_of c USING (doc_id)"""
