from threadweave.operators import motif
from threadweave.operators.graph import PropertyGraph

V = [(1, "ann", "user"), (2, "ben", "user"), (10, "A", "subreddit"), (11, "B", "subreddit")]


def _graph(spark, edges):
    v = spark.createDataFrame(V, "id int, name string, type string")
    e = spark.createDataFrame(edges, "src int, dst int, relationship string")
    return PropertyGraph(v, e)


def test_motif_bag_and_distinct(spark):
    edges = [(1, 10, "posted"), (1, 10, "posted"), (1, 11, "posted"), (2, 10, "posted"), (2, 11, "posted"),
             (1, 2, "commented"), (2, 1, "commented")]
    g = _graph(spark, edges)
    raw = motif.motif_raw(g).collect()
    assert len(raw) == 8
    distinct = {(r.user1, r.subreddit1, r.subreddit2, r.user2): r.matches for r in motif.motif_distinct(g).collect()}
    assert distinct == {("ann", "A", "B", "ben"): 2, ("ann", "B", "A", "ben"): 2,
                        ("ben", "A", "B", "ann"): 2, ("ben", "B", "A", "ann"): 2}


def _busy(spark, n_posted, n_commented):
    edges = ([(1, 10, "posted")] * n_posted + [(1, 11, "posted")] * n_posted + [(2, 10, "posted")] * n_posted + [(2, 11, "posted")] * n_posted
             + [(1, 2, "commented")] * n_commented + [(2, 1, "commented")] * n_commented)
    return _graph(spark, edges)


def test_motif_distinct_of_heavy_users(spark):
    got = motif.motif_distinct(_busy(spark, 1500, 1500)).collect()
    assert len(got) == 4 and {int(r.matches) for r in got} == {1500 ** 6}


def test_motif_raw_above_one_block(spark):
    assert 12 ** 4 * 2 > motif.BLOCK
    raw = motif.motif_raw(_busy(spark, 12, 1))
    assert raw.count() == 4 * 12 ** 4 and raw.distinct().count() == 4


def test_repeat_rows_level_by_level(spark):
    rows = [("a", 0), ("b", 1), ("c", 7), ("d", 8), ("e", 100), ("f", 1000)]
    df = spark.createDataFrame(rows, "k string, n int").selectExpr("k", "cast(n as decimal(38,0)) n")
    got = {r.k: r["count"] for r in motif.repeat_rows(df.filter("n > 0"), "n", block=4).groupBy("k").count().collect()}
    assert got == {k: n for k, n in rows if n}


def test_motif_posted_only(spark):
    # a comment edge that ends in a subreddit id counts for the usual motif only
    edges = [(1, 10, "posted"), (1, 11, "posted"), (2, 10, "posted"), (2, 11, "commented"), (1, 2, "commented"), (2, 1, "commented")]
    g = _graph(spark, edges)
    assert motif.motif_raw(g).count() == 4 and motif.motif_raw(g, posted_only=True).count() == 0
    # edges of another relationship between the users count for the alternate one only
    edges = [(1, 10, "posted"), (1, 11, "posted"), (2, 10, "posted"), (2, 11, "posted"), (1, 2, "knows"), (2, 1, "knows")]
    g = _graph(spark, edges)
    assert motif.motif_raw(g).count() == 0 and motif.motif_raw(g, posted_only=True).count() == 4


def test_motif_needs_both_directions(spark):
    edges = [(1, 10, "posted"), (1, 11, "posted"), (2, 10, "posted"), (2, 11, "posted"), (1, 2, "commented")]
    assert motif.motif_raw(_graph(spark, edges)).count() == 0


def test_motif_joins_each_table_once(spark, monkeypatch):
    """The pair's posts are joined once each; the pairs of shared subreddits need no join."""
    plans = {}
    write = motif.cut
    monkeypatch.setattr(motif, "cut", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and write(df, name))
    named = motif.motif_named(_busy(spark, 2, 1))
    count = lambda text: sum(" Join " in f" {x.lstrip(' :+-')}" for x in text.splitlines())
    assert count(plans["motif-shared"]) == 4   # both directions, posts of either user, the subreddit's name
    assert count(named._jdf.queryExecution().optimizedPlan().toString()) == 2   # the users' names
    assert {int(r.matches) for r in named.collect()} == {2 ** 4}


def test_motif_of_a_long_list(spark):
    subs = 40
    v = spark.createDataFrame([(1, "ann", "user"), (2, "ben", "user")] + [(100 + i, f"s{i}", "subreddit") for i in range(subs)],
                              "id int, name string, type string")
    edges = [(u, 100 + i, "posted") for u in (1, 2) for i in range(subs)] + [(1, 2, "commented"), (2, 1, "commented")]
    g = PropertyGraph(v, spark.createDataFrame(edges, "src int, dst int, relationship string"))
    got = motif.motif_distinct(g).collect()
    assert len(got) == 4 * subs * (subs - 1) // 2 and all(r.matches == 1 and r.subreddit1 != r.subreddit2 for r in got)
