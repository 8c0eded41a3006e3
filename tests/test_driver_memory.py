"""Tables that go through the driver stay within its share of memory."""

import random

import pytest
from pyspark.sql import functions as F

from threadweave import runtime
from threadweave.operators import graph, triangles
from threadweave.operators.graph import PropertyGraph
from threadweave.plans import catalog

# no room in the driver, and none that Spark takes unasked
NO_ROOM = {"threadweave.broadcast.maxBytes": "100", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _posts(spark):
    return spark.range(50).select(F.col("id").cast("int").alias("link_hash"), (F.col("id") % 7).cast("int").alias("op_id"))


def _comments(spark):   # a third on post 0, some on no post
    return spark.range(300).select(F.expr("cast(if(id % 3 = 0, 0, id % 60) as int)").alias("link_hash"), (F.col("id") % 11).cast("int").alias("auth_id"))


@pytest.mark.parametrize("hot", [{}, {runtime.CONF_HOT_MIN_ROWS: "20", runtime.CONF_HOT_MAX_KEYS: "9"}])
def test_posts_beyond_the_drivers_share_are_shuffled(spark, hot):
    posts, comments = _posts(spark), _comments(spark)
    want = sorted(map(tuple, graph.comment_post_edges(posts, comments).collect()))
    with runtime.session_conf(spark, {**NO_ROOM, **hot}):
        plan = graph.post_join_plan(posts, comments)
        edges = graph.comment_post_edges(posts, comments, plan=plan)
        assert "SortMergeJoin" in _plan(edges) and ("BroadcastHashJoin" in _plan(edges)) == bool(hot)
        assert (plan.hot is not None and [r[0] for r in plan.hot.collect()] == [0]) == bool(hot)
        assert sorted(map(tuple, edges.collect())) == want


def test_lists_beyond_the_drivers_share_are_shuffled(spark):
    rng = random.Random(11)
    edges = {(rng.randrange(30), rng.randrange(30)) for _ in range(200)}
    v = spark.range(30).select(F.col("id").cast("int"))
    o = triangles.oriented_edges(PropertyGraph(v, spark.createDataFrame(sorted(edges), "src int, dst int")))
    und = {frozenset(e) for e in edges if len(set(e)) == 2}
    want = sum(frozenset((a, b)) in und and frozenset((b, c)) in und and frozenset((a, c)) in und
               for a in range(30) for b in range(a) for c in range(b))
    for conf, broadcast in ((NO_ROOM, False), ({**NO_ROOM, "threadweave.broadcast.maxBytes": "100000"}, True)):
        with runtime.session_conf(spark, conf):
            found = triangles.triangles_by_lists(o)
            assert ("BroadcastHashJoin" in _plan(found)) == broadcast
            assert found.count() == want > 0


def test_the_drivers_share_follows_its_heap(spark):
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert runtime.broadcast_bytes(spark) == heap // runtime.HEAP_PER_BROADCAST


def _tables(spark, base):
    # customers and parts share the users' names: user o meets users o + 1 and o + 2
    spark.range(40).selectExpr("id as o_orderkey", "id % 6 as o_custkey", "if(id % 2 = 0, 'F', 'O') as o_orderstatus", "1.5D as o_totalprice",
                               "timestamp_ntz'1996-02-03' as o_orderdate", "'5-LOW' as o_orderpriority").write.parquet(f"{base}/orders.parquet")
    spark.range(120).selectExpr("id div 3 as l_orderkey", "(id div 3 + id % 3) % 6 as l_partkey", "0L as l_suppkey", "cast(id % 3 as int) as l_linenumber", "1D as l_quantity",
                                "1D as l_extendedprice", "0D as l_discount", "0D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus",
                                "timestamp_ntz'1996-03-03' as l_shipdate").write.parquet(f"{base}/lineitem.parquet")


@pytest.mark.parametrize("key", ["triangle_count", "triangles_named"])
def test_triangle_queries_do_not_build_posts_in_the_driver(spark, tmp_path, monkeypatch, key):
    _tables(spark, tmp_path)
    graphs, count = [], triangles.triangle_counts
    monkeypatch.setattr(triangles, "triangle_counts", lambda g: graphs.append(g) or count(g))
    want = [tuple(r) for r in catalog.QUERIES[key](spark, str(tmp_path)).collect()]
    with runtime.session_conf(spark, NO_ROOM):
        got = [tuple(r) for r in catalog.QUERIES[key](spark, str(tmp_path)).collect()]
        assert "BroadcastHashJoin" not in _plan(graphs[1].edges)
    assert sorted(got) == sorted(want)
    at = catalog.QUERIES[key](spark, str(tmp_path)).columns.index("count")
    # 0..5 in a ring, each met by the next two: {i, i+1, i+2} and the two alternate ones
    assert [r[at] for r in want] == [4] * 6


def test_names_beside_the_keys_do_not_change_the_plan_of_the_posts(spark):
    """``triangles_named`` writes names with the keys of posts; the join with comments reads keys only."""
    posts, comments = _posts(spark), _comments(spark)
    named = posts.withColumns({"author": F.lit("u1"), "subreddit": F.lit("s")})
    with runtime.session_conf(spark, {runtime.CONF_BROADCAST_ROWS: "50", runtime.CONF_HOT_MIN_ROWS: "20"}):
        assert graph.post_join_plan(posts, comments).hot is None
        assert graph.post_join_plan(named, comments).hot is None   # all posts are broadcast, so no hot ones are sought
