"""Beyond the broadcast bound the loops move messages and sums only: no exchange
stands over the laid-out edges or over a written state, in any phase of a round."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_graph_algorithms import PropertyGraph, _labels, _pagerank_ref, _pg, _scc_ref
from threadweave import runtime
from threadweave.operators import pagerank, scc


def moved(plan: str, *scans: str) -> list[str]:
    """Shuffles that stand over a scan of edges or state without a join or an
    aggregation between them."""
    lines = plan.splitlines()
    found = []
    for i, line in enumerate(lines):
        if any(s in line for s in scans) and "InMemoryRelation" not in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for up in reversed(lines[:i]):
                at = len(up) - len(up.lstrip(" :+-"))
                if at < depth:
                    depth = at
                    if "Join" in up or "Aggregate" in up:
                        break
                    if "Exchange hashpartitioning" in up:
                        found.append(up)
    return found


@pytest.fixture
def recorded(spark, monkeypatch):
    """Plans of all states and tables that a loop writes."""
    plans = []

    def spy(module, name):
        save = getattr(module, name)

        def wrapped(df, label="cut", **metrics):
            if spark.conf.get("spark.sql.adaptive.enabled") == "false":  # inside a loop
                plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
            return save(df, label, **metrics)
        monkeypatch.setattr(module, name, wrapped)

    for module in (scc, pagerank):
        for name in ("cut_observed", "cut_placed"):
            spy(module, name)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield plans
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def hub_edges(n=60, seed=4):
    """A third of the edges end in vertex 0, a quarter start there."""
    rng = random.Random(seed)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(110)]
    return edges + [(rng.randrange(1, n), 0) for _ in range(80)] + [(0, rng.randrange(1, n)) for _ in range(60)]


@pytest.mark.parametrize("rounds", [2, 8])
def test_scc_rounds_move_messages_only(spark, force_split, recorded, rounds):
    edges = hub_edges() + [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(100, 3)]
    got = _labels(scc.scc_labels(_pg(spark, 107, edges), rounds))
    want = _scc_ref(107, edges)
    assert all(got[v] in (v, want[v]) for v in want) and (rounds == 2 or got == want)
    phases = {label for label, _ in recorded}
    assert {"scc-degrees", "scc-colour", "scc-sweep"} <= phases and (rounds == 2 or "scc-work" in phases)
    for label, plan in recorded:
        if label == "scc-work" and "ExistingRDD" not in plan:
            continue  # the vertices are placed once, before the first round
        assert not moved(plan, "InMemoryTableScan", "ExistingRDD"), (label, plan)


@pytest.mark.parametrize("shuffle", ["3", "50"])
def test_pagerank_rounds_move_sums_only(spark, force_split, recorded, shuffle):
    edges = hub_edges()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        got = {r.id: r.pagerank for r in pagerank.pagerank_ranks(_pg(spark, 60, edges)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for i, v in enumerate(_pagerank_ref(60, edges)):
        assert got[i] == pytest.approx(v, abs=1e-9)
    rounds = [plan for label, plan in recorded if label == "pagerank-ranks"]
    assert rounds and not any(moved(plan, "InMemoryTableScan", "ExistingRDD") for plan in rounds)


def test_loop_partitions_follow_the_rows(spark):
    old = spark.conf.get(runtime.CONF_LAYOUT_ROWS, None)
    spark.conf.set(runtime.CONF_LAYOUT_ROWS, "100")
    try:
        with runtime.loop_conf(spark, 5000) as parts:
            assert parts == 50 and spark.conf.get("spark.sql.shuffle.partitions") == "50"
        with runtime.loop_conf(spark, 10) as parts:
            assert parts == 8
    finally:
        spark.conf.unset(runtime.CONF_LAYOUT_ROWS) if old is None else spark.conf.set(runtime.CONF_LAYOUT_ROWS, old)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_placed_states_need_no_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with runtime.loop_conf(spark, 10):
            a, m = runtime.cut_placed(spark.range(500).repartition(8, "id"), "t-placed", top=F.max("id"))
            b = a.filter("id % 2 = 0").withColumn("x", F.col("id") * 2)
            plan = a.join(b, "id")._jdf.queryExecution().executedPlan().toString()
            assert m["rows"] == 500 and m["top"] == 499 and a.join(b, "id").count() == 250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan
    assert isinstance(PropertyGraph(a, b.select(F.col("id").alias("src"), F.col("x").alias("dst"))), PropertyGraph)


@pytest.mark.parametrize("bound", ["0", "40"])
def test_scc_edges_shrink_with_the_work_set(spark, force_split, monkeypatch, bound):
    """A star and a path are peeled, cycles stay: the later steps read the edges
    of the cycles, by joins or by broadcasts of the work set."""
    spark.conf.set(runtime.CONF_BROADCAST_ROWS, bound)
    path = [(i, i + 1) for i in range(8)] + [(i, 60) for i in range(10, 60)]
    edges = path + [(70 + i, 70 + (i + 1) % 9) for i in range(9)] + [(60, 80), (80, 81), (81, 80)]
    groups = {"a": edges, "b": [(v, u) for u, v in edges], "c": [(1, 2)]}
    v = spark.createDataFrame([(g, i) for g in groups for i in [*range(90), None]] + [(None, 1)], "period string, id int")
    e = spark.createDataFrame([(g, s, d) for g, es in groups.items() for s, d in es] + [("a", None, 3), (None, 1, 1)],
                              "period string, src int, dst int")
    left = []
    swept = scc._sweep

    def spy(colours, ground):
        left.append((ground.layout.by_src.all_edges().count(), ground.layout.by_dst.all_edges().count(), ground.g))
        return swept(colours, ground)
    monkeypatch.setattr(scc, "_sweep", spy)
    got = {(r.period, r.id): r.component for r in scc.scc_labels(PropertyGraph(v, e, ("period",)), 3).collect()}
    for g, es in groups.items():
        want = _scc_ref(90, es)
        assert {i: got[g, i] for i in want} == want
    assert got["a", None] is None and got[None, 1] == 1 and len(got) == 3 * 91 + 1
    out, into, key = left[0]
    assert key == [] and max(out, into) < 100   # of 2 * len(edges) + 1 edges, by two numbers as one
    assert bound == "0" or max(out, into) <= 45


def test_scc_of_negative_and_extreme_ids_in_groups(spark):
    ids = [-2**31, -5, 0, 7, 2**31 - 1]
    es = [(ids[i], ids[(i + 1) % 5]) for i in range(5)]
    rows = [("p", 1, *x) for x in es] + [("p", 2, *x) for x in es[1:4]] + [("q", 1, 7, 0), ("q", 1, 0, 7)]
    e = spark.createDataFrame(rows, "period string, part int, src int, dst int")
    v = (e.selectExpr("period", "part", "src as id").union(e.selectExpr("period", "part", "dst as id"))).distinct()
    out = scc.scc_labels(PropertyGraph(v, e, ("period", "part")), 5)
    assert out.schema["component"].dataType == out.schema["id"].dataType
    got = {(r.period, r.part, r.id): r.component for r in out.collect()}
    assert all(got["p", 1, i] == -2**31 for i in ids) and got["q", 1, 7] == got["q", 1, 0] == 0
    assert all(got["p", 2, i] == i for i in ids[1:])


@pytest.mark.parametrize("groups", [["a"], ["a", "b"]])
def test_pagerank_rounds_under_the_bound_shuffle_nothing(spark, recorded, groups):
    """Ranks are broadcast and summed where a target's edges lie."""
    edges = hub_edges()
    e = spark.createDataFrame([(p, s, d) for p in groups for s, d in edges], "period string, src int, dst int")
    v = spark.createDataFrame([(p, i) for p in groups for i in range(60)], "period string, id int")
    graph = PropertyGraph(v, e, ("period",)) if len(groups) > 1 else PropertyGraph(v.drop("period"), e.drop("period"))
    got = pagerank.pagerank_ranks(graph).collect()
    want = _pagerank_ref(60, edges)
    assert len(got) == 60 * len(groups) and all(r.pagerank == pytest.approx(want[r.id], abs=1e-9) for r in got)
    rounds = [plan for label, plan in recorded if label == "pagerank-ranks"]
    assert rounds and not any("Exchange hashpartitioning" in plan.split("InMemoryRelation")[0] for plan in rounds)
