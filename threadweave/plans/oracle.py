"""DuckDB SQL for every catalog key: an independent statement of each result.

Built from shared CTE pieces: the fixture views, the Java hash (a
``list_reduce`` over code points modulo 2^32), prep, both graphs, the season
tables, unrolled PageRank rounds and closure-based SCC.  Column names and
rounding match the Spark side.
"""

from __future__ import annotations

from threadweave.schema import (
    PAGERANK_MAX_ITER, PAGERANK_RESET, TOP_COMPONENTS_PERIOD, TOP_COMPONENTS_SEASON, TOP_PAGERANK,
)
from threadweave.sources.fixture import FIXTURE_ALLOW_LIST, FIXTURE_AUTHORS, SEASON_PERIODS, SLICE4_MONTHS


def jh(col: str) -> str:
    """Java String.hashCode in DuckDB (BMP text)."""
    return (f"(CASE WHEN {col} IS NULL THEN NULL WHEN {col} = '' THEN 0 ELSE "
            f"((list_reduce(list_transform(string_split({col}, ''), lambda ch: unicode(ch)::BIGINT), "
            f"lambda h, k: (h * 31 + k) % 4294967296) + 2147483648) % 4294967296 - 2147483648) END)::INTEGER")


def _lit_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _period_case(col: str = "created_utc") -> str:
    whens = " ".join(f"WHEN {col} >= TIMESTAMP '{s}' AND {col} < TIMESTAMP '{e}' THEN '{k}'"
                     for k, (s, e) in SEASON_PERIODS.items())
    return f"CASE {whens} END"


_SPAN = (min(s for s, _ in SEASON_PERIODS.values()), max(e for _, e in SEASON_PERIODS.values()))

BASE = f"""
lcnt AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
sub_raw AS (
  SELECT 't3_' || o.o_orderkey AS name,
    CASE WHEN o.o_custkey % 50 = 7 THEN '[deleted]' WHEN o.o_custkey % 50 = 8 THEN NULL
         ELSE 'u' || o.o_custkey END AS author,
    o.o_orderpriority || '/' || o.o_orderstatus AS subreddit,
    't5_' || o.o_orderpriority || '/' || o.o_orderstatus AS subreddit_id,
    coalesce(l.n, 0) AS num_comments, o.o_orderdate AS created_utc,
    strftime(o.o_orderdate, '%Y-%m') AS month, o.o_totalprice AS score, o.o_orderstatus AS domain
  FROM orders o LEFT JOIN lcnt l ON l.l_orderkey = o.o_orderkey),
com_raw AS (
  SELECT 't1_' || l.l_orderkey || '_' || l.l_linenumber AS id, 't3_' || l.l_orderkey AS link_id,
    't3_' || l.l_orderkey AS parent_id, l.l_returnflag || l.l_linestatus AS body,
    CASE WHEN l.l_partkey % 50 = 9 THEN '[deleted]' ELSE 'u' || l.l_partkey END AS author,
    o.o_orderpriority || '/' || o.o_orderstatus AS subreddit,
    't5_' || o.o_orderpriority || '/' || o.o_orderstatus AS subreddit_id,
    o.o_orderdate AS created_utc, strftime(o.o_orderdate, '%Y-%m') AS month, l.l_quantity AS score,
    l.l_linenumber AS gilded, l.l_discount AS controversiality, l.l_returnflag AS edited, l.l_shipdate AS retrieved_on
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
posts AS (
  SELECT name, author, subreddit, subreddit_id, num_comments, created_utc, month,
    {jh('name')} AS link_hash, {jh('author')} AS op_id, {jh('subreddit')} AS sub_id
  FROM sub_raw WHERE NOT (author IS NULL OR author = '[deleted]') AND NOT (num_comments = 0)),
comments AS (
  SELECT author, body, created_utc, id, link_id, parent_id, subreddit, subreddit_id,
    {jh('link_id')} AS link_hash, {jh('author')} AS auth_id, {jh('subreddit')} AS sub_id, month
  FROM com_raw WHERE NOT (author IS NULL OR author = '[deleted]')),
uedges AS (SELECT p.op_id AS dst, c.auth_id AS src FROM comments c JOIN posts p ON c.link_hash = p.link_hash),
uverts AS (SELECT op_id AS id FROM posts UNION SELECT auth_id AS id FROM comments),
pverts AS (
  SELECT sub_id AS id, subreddit AS name, 'subreddit' AS type FROM posts
  UNION SELECT op_id, author, 'user' FROM posts
  UNION SELECT auth_id, author, 'user' FROM comments),
pedges AS (
  SELECT op_id AS src, sub_id AS dst, 'posted' AS relationship FROM posts
  UNION ALL SELECT src, dst, 'commented' FROM uedges),
pairs AS (SELECT src, dst, count(*) AS count FROM uedges GROUP BY src, dst),
post_pairs AS (SELECT src, dst, count(*) AS count FROM pedges WHERE relationship = 'posted' GROUP BY src, dst),
s_posts AS (
  SELECT *, {jh('name')} AS link_hash, {jh('author')} AS auth_id, {_period_case()} AS period FROM sub_raw
  WHERE created_utc >= TIMESTAMP '{_SPAN[0]}' AND created_utc < TIMESTAMP '{_SPAN[1]}'
    AND NOT (num_comments = 0) AND NOT (author IS NULL OR author = '[deleted]')),
s_comments AS (
  SELECT *, {jh('link_id')} AS link_hash, {jh('author')} AS auth_id, {_period_case()} AS period FROM com_raw
  WHERE created_utc >= TIMESTAMP '{_SPAN[0]}' AND created_utc < TIMESTAMP '{_SPAN[1]}'
    AND NOT (author IS NULL OR author = '[deleted]')),
per_edges AS (
  SELECT c.period, p.auth_id AS dst, c.auth_id AS src
  FROM s_comments c JOIN s_posts p ON c.period = p.period AND c.link_hash = p.link_hash),
per_verts AS (SELECT period, auth_id AS id FROM s_posts UNION SELECT period, auth_id FROM s_comments),
g_edges AS (SELECT period, dst, src FROM per_edges UNION ALL SELECT 'season', dst, src FROM per_edges),
g_verts AS (SELECT period, id FROM per_verts UNION SELECT 'season', id FROM per_verts),
pair_text AS (
  SELECT c.author || ',' || p.author AS pair, count(*) AS count
  FROM s_posts p JOIN s_comments c ON c.link_hash = p.link_hash GROUP BY 1)
"""


def _with(body: str, *extra: str, recursive: bool = False) -> str:
    ctes = ",\n".join([BASE.strip(), *[e.strip() for e in extra]])
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


def _pagerank(edges: str, verts: str, prefix: str) -> str:
    """CTEs ``{prefix}_final(id, pagerank)`` over edge/vertex CTE names (unrounded)."""
    r = PAGERANK_RESET
    parts = [
        f"{prefix}_od AS (SELECT src, count(*) AS outdeg FROM {edges} GROUP BY src)",
        f"{prefix}_w AS (SELECT e.src, e.dst, count(*)::DOUBLE / any_value(o.outdeg) AS w "
        f"FROM {edges} e JOIN {prefix}_od o ON o.src = e.src GROUP BY e.src, e.dst)",
        f"{prefix}_r0 AS (SELECT DISTINCT id, 1.0::DOUBLE AS pr FROM {verts})",
    ]
    for i in range(1, PAGERANK_MAX_ITER + 1):
        parts.append(
            f"{prefix}_r{i} AS (SELECT v.id, {r}::DOUBLE + {1 - r}::DOUBLE * coalesce(s.t, 0.0::DOUBLE) AS pr "
            f"FROM {prefix}_r0 v LEFT JOIN (SELECT w.dst, sum(p.pr * w.w) AS t FROM {prefix}_w w "
            f"JOIN {prefix}_r{i - 1} p ON p.id = w.src GROUP BY w.dst) s ON s.dst = v.id)")
    last = f"{prefix}_r{PAGERANK_MAX_ITER}"
    parts.append(
        f"{prefix}_final AS (SELECT id, pr * (SELECT count(*) FROM {last}) / (SELECT sum(pr) FROM {last}) AS pagerank "
        f"FROM {last})")
    return ",\n".join(parts)


def _closure(edges: str, prefix: str, grouped: bool = False) -> str:
    """Reachability closure ``{prefix}_reach([g,] a, b)`` (paths of length >= 1)."""
    if grouped:
        return (f"{prefix}_e AS (SELECT DISTINCT period AS g, src, dst FROM {edges}),\n"
                f"{prefix}_reach(g, a, b) AS (SELECT g, src, dst FROM {prefix}_e UNION "
                f"SELECT r.g, r.a, e.dst FROM {prefix}_reach r JOIN {prefix}_e e ON e.g = r.g AND e.src = r.b)")
    return (f"{prefix}_e AS (SELECT DISTINCT src, dst FROM {edges}),\n"
            f"{prefix}_reach(a, b) AS (SELECT src, dst FROM {prefix}_e UNION "
            f"SELECT r.a, e.dst FROM {prefix}_reach r JOIN {prefix}_e e ON e.src = r.b)")


def _scc_full(edges: str, verts: str, prefix: str) -> str:
    """Converged SCC: label = least id among mutually reachable vertices -> ``{prefix}_scc(id, component)``."""
    return ",\n".join([
        _closure(edges, prefix),
        f"{prefix}_mut AS (SELECT r1.b AS id, min(r1.a) AS m FROM {prefix}_reach r1 "
        f"JOIN {prefix}_reach r2 ON r1.a = r2.b AND r1.b = r2.a GROUP BY r1.b)",
        f"{prefix}_scc AS (SELECT v.id, least(v.id, coalesce(m.m, v.id)) AS component "
        f"FROM (SELECT DISTINCT id FROM {verts}) v LEFT JOIN {prefix}_mut m ON m.id = v.id)",
    ])


def _scc_two_rounds(edges: str, verts: str, prefix: str, grouped: bool = False) -> str:
    """SCC after two outer rounds (one colouring) -> ``{prefix}_scc([g,] id, component)``.

    Work set = vertices that reach a cycle and are reached from one (what
    trimming leaves); colour = least work ancestor; settled iff the vertex
    reaches its colour."""
    g, gc = ("g, ", "r.g = v.g AND ") if grouped else ("", "")
    vsrc = (f"(SELECT DISTINCT period AS g, id FROM {verts})" if grouped
            else f"(SELECT DISTINCT id FROM {verts})")
    return ",\n".join([
        _closure(edges, prefix, grouped),
        f"{prefix}_cyc AS (SELECT DISTINCT {g}a AS id FROM {prefix}_reach WHERE a = b)",
        f"{prefix}_fwd AS (SELECT DISTINCT {'r.g, ' if grouped else ''}r.a AS id FROM {prefix}_reach r JOIN {prefix}_cyc c "
        f"ON {'c.g = r.g AND ' if grouped else ''}c.id = r.b UNION SELECT {g}id FROM {prefix}_cyc)",
        f"{prefix}_bwd AS (SELECT DISTINCT {'r.g, ' if grouped else ''}r.b AS id FROM {prefix}_reach r JOIN {prefix}_cyc c "
        f"ON {'c.g = r.g AND ' if grouped else ''}c.id = r.a UNION SELECT {g}id FROM {prefix}_cyc)",
        f"{prefix}_work AS (SELECT {g}id FROM {prefix}_fwd INTERSECT SELECT {g}id FROM {prefix}_bwd)",
        f"{prefix}_col AS (SELECT {'w.g, ' if grouped else ''}w.id, least(w.id, coalesce(min(r.a), w.id)) AS color "
        f"FROM {prefix}_work w LEFT JOIN ({prefix}_reach r JOIN {prefix}_work wa ON "
        f"{'wa.g = r.g AND ' if grouped else ''}wa.id = r.a) ON {'r.g = w.g AND ' if grouped else ''}r.b = w.id "
        f"GROUP BY {'w.g, ' if grouped else ''}w.id)",
        f"{prefix}_scc AS (SELECT {'v.g AS period, ' if grouped else ''}v.id, CASE WHEN c.color IS NOT NULL AND "
        f"(c.color = v.id OR EXISTS (SELECT 1 FROM {prefix}_reach r WHERE {gc}r.a = v.id AND r.b = c.color)) "
        f"THEN c.color ELSE v.id END AS component FROM {vsrc} v LEFT JOIN {prefix}_col c ON "
        f"{'c.g = v.g AND ' if grouped else ''}c.id = v.id)",
    ])


def _members(scc: str, graph: str) -> str:
    return f"""SELECT '{graph}' AS graph, z.component, z.count, m.member, n.name, n.type
FROM (SELECT component, count(*) AS count FROM {scc} GROUP BY component HAVING count(*) > 2) z
JOIN (SELECT DISTINCT c.component, p.name AS member FROM {scc} c JOIN pverts p ON p.id = c.id) m ON m.component = z.component
JOIN pverts n ON n.id = z.component"""


def _sizes(scc: str, graph: str) -> str:
    return (f"SELECT '{graph}' AS graph, z.component, z.count, n.name, n.type FROM "
            f"(SELECT component, count(*) AS count FROM {scc} GROUP BY component HAVING count(*) > 2) z "
            f"JOIN pverts n ON n.id = z.component")


def _named_pairs(pairs: str) -> str:
    return (f"SELECT p.dst, p.src, p.count, a.name AS src_name, a.type AS src_type, b.name AS dst_name, "
            f"b.type AS dst_type FROM {pairs} p JOIN pverts a ON a.id = p.src JOIN pverts b ON b.id = p.dst "
            f"WHERE p.count > 1 AND p.src <> p.dst")


def _common_dst(pairs: str) -> str:
    return (f"SELECT d.dst, d.count, n.name, n.type FROM (SELECT dst, count(*) AS count FROM {pairs} "
            f"GROUP BY dst) d JOIN pverts n ON n.id = d.dst")


_MOTIF = """
m_sub AS (SELECT DISTINCT id FROM pverts WHERE type = 'subreddit'),
m_posts AS (SELECT src AS u, dst AS s, count(*) AS n FROM pedges WHERE dst IN (SELECT id FROM m_sub) GROUP BY 1, 2),
m_comm AS (SELECT src, dst, count(*) AS n FROM pedges WHERE relationship = 'commented' GROUP BY 1, 2),
m_mut AS (SELECT f.src AS u, f.dst AS u2, f.n AS n6, b.n AS n5 FROM m_comm f
          JOIN m_comm b ON b.src = f.dst AND b.dst = f.src WHERE f.src < f.dst),
m_shared AS (SELECT m.u, m.u2, p1.s, p1.n AS n1, p2.n AS n3, m.n5, m.n6 FROM m_mut m
             JOIN m_posts p1 ON p1.u = m.u JOIN m_posts p2 ON p2.u = m.u2 AND p2.s = p1.s),
m_quad AS (SELECT a.u, a.u2, a.s, b.s AS s2, a.n1 * b.n1 * a.n3 * b.n3 * a.n5 * a.n6 AS matches
           FROM m_shared a JOIN m_shared b ON a.u = b.u AND a.u2 = b.u2 AND a.s < b.s),
m_all AS (SELECT u, s, s2, u2, matches FROM m_quad UNION ALL SELECT u, s2, s, u2, matches FROM m_quad
          UNION ALL SELECT u2, s, s2, u, matches FROM m_quad UNION ALL SELECT u2, s2, s, u, matches FROM m_quad),
m_named AS (SELECT vu.name AS user1, vs.name AS subreddit1, vs2.name AS subreddit2, vu2.name AS user2, m.matches
            FROM m_all m JOIN pverts vu ON vu.id = m.u JOIN pverts vs ON vs.id = m.s AND vs.type = 'subreddit'
            JOIN pverts vs2 ON vs2.id = m.s2 AND vs2.type = 'subreddit' JOIN pverts vu2 ON vu2.id = m.u2),
m_distinct AS (SELECT user1, subreddit1, subreddit2, user2, sum(matches)::VARCHAR AS matches FROM m_named
               GROUP BY 1, 2, 3, 4)
"""

# the alternate predicates: posted edges into subreddits, any edge between the users
_MOTIF_POSTED = _MOTIF.replace("FROM pedges WHERE dst IN", "FROM pedges WHERE relationship = 'posted' AND dst IN").replace(
    "FROM pedges WHERE relationship = 'commented' GROUP BY", "FROM pedges GROUP BY")

_TRI = """
t_und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM uedges WHERE src <> dst),
t_tri AS (SELECT x.a AS u, x.b AS v, y.b AS w FROM t_und x JOIN t_und y ON y.a = x.a AND y.b > x.b
          JOIN t_und z ON z.a = x.b AND z.b = y.b),
t_cnt AS (SELECT id, count(*) AS count FROM (SELECT u AS id FROM t_tri UNION ALL SELECT v FROM t_tri
          UNION ALL SELECT w FROM t_tri) GROUP BY id),
t_all AS (SELECT v.id, coalesce(c.count, 0)::BIGINT AS count FROM uverts v LEFT JOIN t_cnt c ON c.id = v.id)
"""

_SEASON_TRI = _TRI.replace("FROM uedges", "FROM s_e").replace("FROM uverts", "FROM s_v")
_SEASON_GRAPH = ("s_e AS (SELECT dst, src FROM g_edges WHERE period = 'season')",
                 "s_v AS (SELECT id FROM g_verts WHERE period = 'season')")


def _weights(edges: str, columns: str) -> str:
    return (f"SELECT {columns}, 1.0 / o.outdeg AS weight FROM {edges} e "
            f"JOIN (SELECT src, count(*) AS outdeg FROM {edges} GROUP BY src) o ON o.src = e.src")

ORACLE: dict[str, str] = {
    "load_months": _with(f"SELECT * FROM sub_raw WHERE month IN ({_lit_list(SLICE4_MONTHS)})"),
    "remove_deleted_authors": _with("SELECT * FROM sub_raw WHERE NOT (author IS NULL OR author = '[deleted]')"),
    "remove_zero_comment_posts": _with("SELECT * FROM sub_raw WHERE NOT (num_comments = 0)"),
    "filter_subreddits": _with(f"SELECT * FROM sub_raw WHERE subreddit IN ({_lit_list(FIXTURE_ALLOW_LIST)})"),
    "trim_submissions": _with("SELECT * FROM posts"),
    "trim_comments": _with("SELECT * FROM comments"),
    "trim_season": _with("SELECT id, link_id, parent_id, body, author, subreddit, subreddit_id, created_utc, month, "
                         "period, link_hash, auth_id FROM s_comments"),
    "season_prep_allowed": _with(
        "SELECT name, author, subreddit, subreddit_id, num_comments, created_utc, month, period, link_hash, auth_id "
        f"FROM s_posts WHERE subreddit IN ({_lit_list(FIXTURE_ALLOW_LIST)})"),
    "java_string_hash": _with(
        f"SELECT name, {jh('name')} AS name_hash, author, {jh('author')} AS author_hash, "
        f"subreddit, {jh('subreddit')} AS subreddit_hash FROM sub_raw"),
    "user_vertices": _with("SELECT id FROM uverts"),
    "comment_post_edges": _with("SELECT dst, src FROM uedges"),
    "property_graph_vertices": _with("SELECT id, name, type FROM pverts"),
    "property_graph_edges": _with("SELECT src, dst, relationship FROM pedges"),
    "season_union": _with("SELECT period, dst, src FROM g_edges"),
    "id_collisions": _with("SELECT id, count(*) AS count FROM pverts GROUP BY id HAVING count(*) > 1"),
    "popular_pairs": _with("SELECT src, dst, count FROM pairs"),
    "user_post_subreddit_counts": _with("SELECT src, dst, count FROM post_pairs"),
    "popular_pairs_named": _with(_named_pairs("pairs")),
    "popular_posters_named": _with(_named_pairs("post_pairs")),
    "most_common_dst": _with(_common_dst("pairs")),
    "most_common_subreddit": _with(_common_dst("post_pairs")),
    "author_subreddit_counts": _with(
        f"SELECT author, subreddit, count(*) AS count FROM comments WHERE author IN ({_lit_list(FIXTURE_AUTHORS)}) "
        f"GROUP BY author, subreddit"),
    "pair_counts_text": _with("SELECT pair, count FROM pair_text"),
    "pagerank_users": _with("SELECT id, round(pagerank, 6) AS pagerank FROM u_final",
                            _pagerank("uedges", "uverts", "u")),
    "pagerank_edge_weights": _with(_weights("uedges", "e.dst, e.src")),
    "pagerank_property_edges": _with(_weights("pedges", "e.src, e.dst, e.relationship")),
    "season_pagerank": _with("SELECT id, round(pagerank, 6) AS pagerank FROM s_final", *_SEASON_GRAPH,
                             _pagerank("s_e", "s_v", "s")),
    "season_pagerank_edges": _with(_weights("s_e", "e.dst, e.src"), *_SEASON_GRAPH),
    "pagerank_property_graph": _with(
        "SELECT v.id, v.name, v.type, round(f.pagerank, 6) AS pagerank FROM pverts v JOIN p_final f ON f.id = v.id",
        _pagerank("pedges", "pverts", "p")),
    "pagerank_users_named": _with(
        "SELECT f.id, round(f.pagerank, 6) AS pagerank, v.name, v.type FROM u_final f JOIN pverts v ON v.id = f.id",
        _pagerank("uedges", "uverts", "u")),
    "top_pagerank": _with(
        f"SELECT id, round(pagerank, 6) AS pagerank FROM s_final ORDER BY round(pagerank, 6) DESC, id "
        f"LIMIT {TOP_PAGERANK}",
        *_SEASON_GRAPH,
        _pagerank("s_e", "s_v", "s")),
    "scc_users": _with("SELECT id, component FROM u_scc", _scc_full("uedges", "uverts", "u"), recursive=True),
    "scc_bounded": _with("SELECT id, component FROM u_scc", _scc_two_rounds("uedges", "uverts", "u"),
                         recursive=True),
    "scc_property_graph": _with(
        "SELECT v.id, v.name, v.type, s.component FROM pverts v JOIN p_scc s ON s.id = v.id",
        _scc_full("pedges", "pverts", "p"), recursive=True),
    "scc_monthly": _with("SELECT period, id, component FROM g_scc",
                         _scc_two_rounds("g_edges", "g_verts", "g", grouped=True), recursive=True),
    "scc_component_sizes": _with(
        _sizes("u_scc", "users") + "\nUNION ALL\n" + _sizes("p_scc2", "property"),
        _scc_full("uedges", "uverts", "u"), _scc_full("pedges", "pverts", "p"),
        "p_scc2 AS (SELECT v.id, s.component FROM pverts v JOIN p_scc s ON s.id = v.id)", recursive=True),
    "scc_component_members": _with(
        _members("u_scc", "users") + "\nUNION ALL\n" + _members("p_scc2", "property"),
        _scc_full("uedges", "uverts", "u"), _scc_full("pedges", "pverts", "p"),
        "p_scc2 AS (SELECT v.id, s.component FROM pverts v JOIN p_scc s ON s.id = v.id)", recursive=True),
    "top_components": _with(
        f"SELECT period, rank, component, count FROM (SELECT period, component, count, row_number() OVER "
        f"(PARTITION BY period ORDER BY count DESC, component) AS rank FROM (SELECT period, component, "
        f"count(*) AS count FROM g_scc GROUP BY 1, 2)) WHERE rank <= CASE WHEN period = 'season' THEN "
        f"{TOP_COMPONENTS_SEASON} ELSE {TOP_COMPONENTS_PERIOD} END",
        _scc_two_rounds("g_edges", "g_verts", "g", grouped=True), recursive=True),
    "comments_of_top_author": _with(
        "SELECT c.period, c.author, c.id, c.link_id, c.subreddit, c.created_utc, c.link_hash, c.auth_id "
        "FROM s_comments c JOIN (SELECT period, component AS auth_id FROM (SELECT period, component, "
        "row_number() OVER (PARTITION BY period ORDER BY count DESC, component) AS rn FROM "
        "(SELECT period, component, count(*) AS count FROM g_scc WHERE period <> 'season' GROUP BY 1, 2)) "
        "WHERE rn = 1) t ON t.period = c.period AND t.auth_id = c.auth_id",
        _scc_two_rounds("g_edges", "g_verts", "g", grouped=True), recursive=True),
    "motif_collab": _with(
        "SELECT user1, subreddit1, subreddit2, user2 FROM (SELECT *, unnest(range(matches)) AS k FROM m_named)",
        _MOTIF),
    "motif_collab_distinct": _with("SELECT * FROM m_distinct", _MOTIF),
    "motif_posted_only": _with("SELECT * FROM m_distinct", _MOTIF_POSTED),
    "season_triangles": _with("SELECT id, count FROM t_all", *_SEASON_GRAPH, _SEASON_TRI),
    "triangle_count": _with("SELECT id, count FROM t_all", _TRI),
    "triangles_named": _with(
        "SELECT t.id, t.count, v.name, v.type FROM t_all t JOIN pverts v ON v.id = t.id", _TRI),
    "stage_roundtrip": _with("SELECT * FROM comments"),
    "csv_export": _with(_named_pairs("pairs")),
    "json_export": _with(
        "SELECT user1, subreddit1, subreddit2, user2 FROM (SELECT *, unnest(range(matches)) AS k FROM m_named)",
        _MOTIF),
    "text_export": _with("SELECT '(' || pair || ',' || count || ')' AS value FROM pair_text"),
}
# the season variant from month folders gives what the date ranges give
ORACLE["season_from_folders"] = ORACLE["scc_monthly"]
