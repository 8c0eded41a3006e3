import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadweave import runtime
from threadweave.operators import pagerank, scc, triangles
from threadweave.operators.graph import PropertyGraph

# Golden values from GraphX on the hand graph.
PAGERANK_GOLDEN = {1: 0.49917037210928045, 2: 0.6453417469500742, 3: 3.2764264940843595,
                   4: 0.6040750416538077, 5: 0.4795850103905133, 6: 0.8913262931581574,
                   7: 0.6040750416538077}


def _labels(df):
    return {r.id: r.component for r in df.collect()}


def test_scc_hand(hand_graph):
    assert _labels(scc.scc_labels(hand_graph, 1)) == {i: i for i in range(1, 8)}
    want = {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7}
    assert _labels(scc.scc_labels(hand_graph, 2)) == want
    assert _labels(scc.scc_labels(hand_graph, 3)) == want


def test_triangles_hand(hand_graph):
    got = {r.id: r["count"] for r in triangles.triangle_counts(hand_graph).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 0}


def test_pagerank_hand(hand_graph):
    got = {r.id: r.pagerank for r in pagerank.pagerank_ranks(hand_graph).collect()}
    assert got.keys() == PAGERANK_GOLDEN.keys()
    for k, v in PAGERANK_GOLDEN.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_edge_weights_hand(hand_graph):
    w = pagerank.edge_weights(hand_graph)
    assert w.count() == 10
    got = {(r.src, r.dst): r.weight for r in w.collect()}
    assert got[(1, 2)] == 0.5 and got[(2, 1)] == 0.5 and got[(3, 3)] == 1.0


def test_split_plans_match(spark, hand_graph, force_split):
    want = {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7}
    assert _labels(scc.scc_labels(hand_graph, 3)) == want
    got = {r.id: r.pagerank for r in pagerank.pagerank_ranks(hand_graph).collect()}
    for k, v in PAGERANK_GOLDEN.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


# ---- brute-force references --------------------------------------------------------------------

def _reach(n, edges):
    adj = {i: set() for i in range(n)}
    for a, b in edges:
        adj[a].add(b)
    out = {}
    for s in range(n):
        seen, stack = set(), [s]
        while stack:
            x = stack.pop()
            for y in adj[x]:
                if y not in seen:
                    seen.add(y)
                    stack.append(y)
        out[s] = seen
    return out


def _scc_ref(n, edges):
    r = _reach(n, edges)
    return {v: min([v] + [u for u in range(n) if u in r[v] and v in r[u]]) for v in range(n)}


def _pagerank_ref(n, edges, iters=10):
    outdeg = [0] * n
    for a, _ in edges:
        outdeg[a] += 1
    r = [1.0] * n
    for _ in range(iters):
        s = [0.0] * n
        for a, b in edges:
            s[b] += r[a] / outdeg[a]
        r = [0.15 + 0.85 * x for x in s]
    tot = sum(r)
    return [x * n / tot for x in r]


def _tri_ref(n, edges):
    und = {(min(a, b), max(a, b)) for a, b in edges if a != b}
    nb = {i: set() for i in range(n)}
    for a, b in und:
        nb[a].add(b)
        nb[b].add(a)
    return {v: sum(1 for a in nb[v] for b in nb[v] if a < b and b in nb[a]) for v in range(n)}


graphs = st.integers(min_value=2, max_value=9).flatmap(
    lambda n: st.tuples(st.just(n), st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1)),
                                              min_size=0, max_size=24)))


def _pg(spark, n, edges, offset=0):
    v = spark.createDataFrame([(i + offset,) for i in range(n)], "id int")
    e = spark.createDataFrame([(a + offset, b + offset) for a, b in edges] or [], "src int, dst int")
    return PropertyGraph(v, e)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(graphs)
def test_properties_random_graphs(spark, g):
    n, edges = g
    pg = _pg(spark, n, edges)
    # converged SCC (n rounds is always enough) = least id among mutually reachable vertices
    assert _labels(scc.scc_labels(pg, n + 1)) == _scc_ref(n, edges)
    ranks = {r.id: r.pagerank for r in pagerank.pagerank_ranks(pg).collect()}
    for i, v in enumerate(_pagerank_ref(n, edges)):
        assert ranks[i] == pytest.approx(v, abs=1e-9)
    assert sum(ranks.values()) == pytest.approx(n)
    tri = {r.id: r["count"] for r in triangles.triangle_counts(pg).collect()}
    assert tri == _tri_ref(n, edges)
    assert sum(tri.values()) % 3 == 0


def test_grouped_equals_separate(spark):
    rnd = random.Random(7)
    parts = []
    for label in ("A", "B"):
        edges = [(rnd.randrange(8), rnd.randrange(8)) for _ in range(14)]
        parts.append((label, edges))
    v = spark.createDataFrame([(lab, i) for lab, _ in parts for i in range(8)], "g string, id int")
    e = spark.createDataFrame([(lab, a, b) for lab, es in parts for a, b in es], "g string, src int, dst int")
    grouped = PropertyGraph(v, e, ("g",))
    got = {(r.g, r.id): r.component for r in scc.scc_labels(grouped, 2).collect()}
    got_pr = {(r.g, r.id): r.pagerank for r in pagerank.pagerank_ranks(grouped).collect()}
    for lab, es in parts:
        single = _labels(scc.scc_labels(_pg(spark, 8, es), 2))
        assert {i: got[(lab, i)] for i in range(8)} == single
        ref = _pagerank_ref(8, es)
        for i in range(8):
            assert got_pr[(lab, i)] == pytest.approx(ref[i], abs=1e-9)


def test_two_round_scc_differs_from_the_full_one(spark):
    # the first colouring gives 2 and 3 the colour of their ancestor 1, whose root they don't reach
    pg = _pg(spark, 4, [(0, 3), (3, 0), (0, 1), (1, 2), (2, 1)])
    assert _labels(scc.scc_labels(pg, 2)) == {0: 0, 3: 0, 1: 1, 2: 2}
    assert _labels(scc.scc_labels(pg, 3)) == {0: 0, 3: 0, 1: 1, 2: 1}


def test_bounded_scc_is_partial(spark):
    # a long cycle plus a chain feeding it: round 2 settles the cycle only after colouring
    edges = [(i, i + 1) for i in range(5)] + [(5, 1)] + [(6, 0)]
    pg = _pg(spark, 7, edges)
    full = _scc_ref(7, edges)
    assert _labels(scc.scc_labels(pg, 10)) == full
    assert _labels(scc.scc_labels(pg, 1)) == {i: i for i in range(7)}


def test_triangles_hub_split(spark, force_split):
    """A hub heading most oriented edges goes through the broadcast hot branch."""
    edges = [(0, i) for i in range(1, 9)] + [(i, i + 1) for i in range(1, 8)] + [(1, 8)]
    pg = _pg(spark, 9, edges)
    got = {r.id: r["count"] for r in triangles.triangle_counts(pg).collect()}
    assert got == _tri_ref(9, edges)


def _exchanges_over(plan: str, name: str) -> int:
    """Exchanges that stand directly on a scan with ``name`` in the plan's text."""
    lines = plan.splitlines()
    hits = 0
    for i, line in enumerate(lines):
        if name in line:
            depth = line.find(line.lstrip(" :+-"))
            for up in reversed(lines[:i]):
                at = up.find(up.lstrip(" :+-"))
                if at < depth:
                    depth = at
                    if "Join" in up:
                        break
                    hits += "Exchange" in up
    return hits


def test_steps_do_not_shuffle_laid_out_edges(spark, force_split):
    from threadweave.operators.joins import lay_out
    from threadweave.runtime import cut, loop_conf

    edges = cut(spark.range(2000).select((F.col("id") % 97).cast("int").alias("src"), (F.col("id") % 89).cast("int").alias("dst")).distinct(), "t-edges")
    state = cut(spark.range(97).select(F.col("id").cast("int").alias("src"), F.rand(1).alias("x")), "t-state")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with loop_conf(spark):
            layout = lay_out(edges, ["src"], edges.count(), 97)
            step = layout.join(state, 97)
            plan = step._jdf.queryExecution().executedPlan().toString()
            n = step.count()
            layout.release()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert n == edges.count()
    assert "InMemoryTableScan" in plan and "SortMergeJoin" in plan
    assert _exchanges_over(plan, "InMemoryTableScan") == 0


def test_triangles_send_one_id_per_wedge_at_most(spark):
    from threadweave.operators.triangles import oriented_edges, wedge_count, wedge_tails
    from threadweave.plans.catalog import Pipeline
    from tests.conftest import SF_SMALL

    o = oriented_edges(Pipeline(spark, SF_SMALL).user_graph)
    lists, tails, _ = wedge_tails(o)
    sizes = [r[0] for r in lists.select(F.size("nu")).collect()]
    assert wedge_count(o) == sum(n * (n - 1) // 2 for n in sizes)
    assert tails.agg(F.sum(F.size("tail"))).first()[0] <= wedge_count(o)


def _both_plans(spark, pg, b):
    from threadweave.operators.triangles import BLOCK_CONF, corner_counts, oriented_edges, triangles_by_blocks, triangles_by_lists
    o = oriented_edges(pg)
    count = lambda t: {r.id: r["count"] for r in corner_counts(t, []).collect()}
    with runtime.session_conf(spark, BLOCK_CONF):
        blocks = triangles_by_blocks(o, b)
        plan, counts = blocks._jdf.queryExecution().executedPlan().toString(), count(blocks)
    return counts, count(triangles_by_lists(o)), plan


@pytest.mark.parametrize("b, rows", [(1, None), (3, None), (5, "1")])
def test_triangle_plans_agree(spark, b, rows):
    rng = random.Random(b)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(160)] + [(0, i) for i in range(1, 30)]
    want = {v: n for v, n in _tri_ref(30, edges).items() if n}
    conf = {} if rows is None else {runtime.CONF_LAYOUT_ROWS: rows}   # one row a partition: the largest pair is too large to hash
    with runtime.session_conf(spark, conf):
        blocks, lists, plan = _both_plans(spark, _pg(spark, 30, edges), b)
    assert blocks == lists == want
    assert "Exchange" not in plan and ("SortMergeJoin" in plan) == (rows is not None)


def test_block_copies_fall_behind_wedges(spark):
    from threadweave.operators.triangles import block_edges, n_blocks, oriented_edges, wedge_count
    gain = []
    for n in (12, 24, 48):
        o = oriented_edges(_pg(spark, n, [(i, j) for i in range(n) for j in range(i)]))
        b = n_blocks(spark, o.m)
        assert block_edges(o, b).count() == o.m * b
        gain.append(wedge_count(o) / (2 * o.m * b))
    assert gain[2] > 1.8 * gain[1] > 3 * gain[0]


def test_triangles_of_grouped_graphs(spark):
    rng = random.Random(3)
    parts = {lab: [(rng.randrange(9), rng.randrange(9)) for _ in range(30)] for lab in "AB"}
    v = spark.createDataFrame([(lab, i) for lab in parts for i in range(9)], "g string, id int")
    e = spark.createDataFrame([(lab, *x) for lab, es in parts.items() for x in es], "g string, src int, dst int")
    got = {(r.g, r.id): r["count"] for r in triangles.triangle_counts(PropertyGraph(v, e, ("g",))).collect()}
    assert got == {(lab, i): n for lab, es in parts.items() for i, n in _tri_ref(9, es).items()}


@pytest.mark.parametrize("key", ["scc_users", "scc_bounded", "pagerank_users", "triangle_count", "comment_post_edges"])
def test_forced_split_equals_the_oracle(spark, force_split, key):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL
    from tools.oracle_check import digest, duck

    df = entry.queries()[key](spark, SF_SMALL)
    rel = duck(SF_SMALL).sql(entry.oracle_sql()[key])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())


def test_property_graph_reuses_the_labels_of_its_user_graph(spark, monkeypatch):
    from threadweave.plans import catalog
    from tests.conftest import SF_SMALL
    runs = []
    labels = scc.scc_labels
    monkeypatch.setattr(scc, "scc_labels", lambda *a, **k: runs.append(1) or labels(*a, **k))
    df = catalog.q_scc_component_members(spark, SF_SMALL)
    assert len(runs) == 1 and {r.graph for r in df.select("graph").distinct().collect()} == {"users", "property"}


@pytest.mark.parametrize("rounds", [2, 6])
@pytest.mark.parametrize("subreddit", [50, 3])   # 3: a subreddit whose id is also a user's
def test_property_labels_equal_a_run_of_their_own(spark, rounds, subreddit):
    users = [(1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 3), (6, 1)]
    edges = [(a, b, "commented") for a, b in users] + [(u, subreddit, "posted") for u in (1, 4, 6)]
    v = spark.createDataFrame([(i, f"u{i}", "user") for i in range(1, 7)] + [(subreddit, "s", "subreddit")], "id int, name string, type string")
    g = PropertyGraph(v, spark.createDataFrame(edges, "src int, dst int, relationship string"))
    user_labels = scc.scc_labels(_pg(spark, 6, [(a - 1, b - 1) for a, b in users], 1), rounds)
    got = sorted((r.id, r.type, r.component) for r in scc.property_labels(user_labels, g, rounds).collect())
    assert got == sorted((r.id, r.type, r.component) for r in scc.strongly_connected_components(g, rounds).collect())


def test_string_ids_weigh_more_in_the_broadcast_bound(spark):
    from threadweave.operators.joins import broadcast_ok
    with runtime.session_conf(spark, {runtime.CONF_BROADCAST_ROWS: "100"}):
        assert broadcast_ok(spark.createDataFrame([(1,)], "id int"), 100)
        names = spark.createDataFrame([("u/a",)], "id string")
        assert broadcast_ok(names, 25) and not broadcast_ok(names, 26)


def test_triangle_plan_follows_the_bytes(spark, monkeypatch):
    """Copies are wider than the ids of a tail: on a sparse graph lists are sent, on a dense one copies to blocks."""
    from threadweave.operators import triangles as tri
    assert not tri.blocks_move_less(spark, 3_300_000, 4, 53_000_000)   # six copies of sf0.1
    assert tri.blocks_move_less(spark, 3_300_000, 4, 3_300_000 * 1000)
    rng = random.Random(7)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(300)]
    want = _tri_ref(40, edges)
    for answer in (True, False):
        monkeypatch.setattr(tri, "blocks_move_less", lambda *a, answer=answer: answer)
        assert {r.id: r["count"] for r in tri.triangle_counts(_pg(spark, 40, edges)).collect()} == {v: want[v] for v in range(40)}


def test_block_plan_hashes_by_the_largest_partition(spark):
    """Each pair of blocks is small, but a task holds several triples."""
    from threadweave.operators.triangles import BLOCK_CONF, oriented_edges, triangles_by_blocks
    edges = [(i, j) for i in range(30) for j in range(i)]
    o = oriented_edges(_pg(spark, 30, edges))
    with runtime.session_conf(spark, {**BLOCK_CONF, runtime.CONF_LAYOUT_ROWS: "160"}):
        found = triangles_by_blocks(o, 4)
        assert found.count() == 30 * 29 * 28 // 6
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
