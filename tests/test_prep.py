from datetime import datetime

from pyspark.sql import functions as F

from threadweave.operators import graph, prep
from threadweave.sources.monthly import union_months

POST_SCHEMA = "name string, author string, subreddit string, num_comments int, created_utc timestamp_ntz, month string"


def _posts(spark):
    t = datetime(2016, 8, 1)
    rows = [
        ("t3_a", None, "politics", 3, t, "08"),          # null author
        ("t3_b", "[deleted]", "politics", 3, t, "08"),   # deleted author
        ("t3_c", "alice", "politics", 0, t, "08"),       # zero comments
        ("t3_d", "alice", "politics", None, t, "08"),    # null count: dropped by NOT (x = 0)
        ("t3_e", "alice", "cooking", 2, t, "08"),        # not in the list
        ("t3_f", "bob", "Politics", 2, t, "08"),         # other letter case
        ("t3_g", "bob", "politics", 5, t, "08"),
    ]
    return spark.createDataFrame(rows, POST_SCHEMA)


def test_filters(spark):
    raw = _posts(spark)
    assert sorted(r.name for r in prep.remove_deleted_authors(raw).collect()) == ["t3_c", "t3_d", "t3_e", "t3_f", "t3_g"]
    assert sorted(r.name for r in prep.remove_zero_comment_posts(raw).collect()) == ["t3_a", "t3_b", "t3_e", "t3_f", "t3_g"]
    kept = prep.filter_subreddits(raw, ["politics"]).collect()
    assert sorted(r.name for r in kept) == ["t3_a", "t3_b", "t3_c", "t3_d", "t3_g"]
    assert prep.filter_subreddits(raw, None).count() == raw.count()


def test_prep_posts_ids(spark):
    out = prep.prep_submissions(_posts(spark), ["politics"]).collect()
    assert [r.name for r in out] == ["t3_g"]
    assert out[0].sub_id == 547400545
    assert set(prep.prep_submissions(_posts(spark)).columns) >= {"link_hash", "op_id", "sub_id"}


def test_comment_edges_edge_cases(spark):
    t = datetime(2016, 8, 1)
    posts = prep.prep_submissions(spark.createDataFrame(
        [("t3_p", "alice", "politics", 4, t, "08"), ("t3_q", "bob", "politics", 1, t, "08")], POST_SCHEMA))
    comments = spark.createDataFrame([
        ("c1", "t3_p", "t3_p", "", "bob", "politics", "t5_x", t, "08"),
        ("c2", "t3_p", "t3_p", "", "bob", "politics", "t5_x", t, "08"),        # parallel edge
        ("c3", "t3_p", "t3_p", "", "alice", "politics", "t5_x", t, "08"),      # self-comment -> self-loop
        ("c4", "t3_missing", "t3_missing", "", "carol", "politics", "t5_x", t, "08"),  # post not present
        ("c5", "t3_q", "t3_q", "", None, "politics", "t5_x", t, "08"),         # null author
        ("c6", "t3_q", "t3_q", "", "[deleted]", "politics", "t5_x", t, "08"),
    ], "id string, link_id string, parent_id string, body string, author string, subreddit string, "
       "subreddit_id string, created_utc timestamp_ntz, month string")
    c = prep.prep_comments(comments)
    assert c.count() == 4
    assert len(c.columns) == 12
    g = graph.user_graph(posts, c)
    assert g.edges.count() == 3
    assert g.edges.filter(F.col("src") == F.col("dst")).count() == 1
    assert g.vertices.count() == 3        # alice, bob, carol (carol has no edge)


def test_union_months_with_drift(spark):
    a = spark.createDataFrame([("x", 1)], "name string, num_comments int")
    b = spark.createDataFrame([(2, "y", "extra")], "num_comments int, name string, score string")
    u = union_months([a, b])
    rows = sorted((r.name, r.num_comments, r.score) for r in u.collect())
    assert rows == [("x", 1, None), ("y", 2, "extra")]


def test_hot_post_split_join(spark, force_split):
    """A post holding most comments goes through the broadcast hot branch."""
    t = datetime(2016, 8, 1)
    posts = prep.prep_submissions(spark.createDataFrame(
        [("t3_p", "alice", "politics", 6, t, "08"), ("t3_q", "bob", "politics", 1, t, "08")], POST_SCHEMA))
    rows = [(f"c{i}", "t3_p", "t3_p", "", f"user{i % 3}", "politics", "t5_x", t, "08") for i in range(6)]
    rows.append(("c9", "t3_q", "t3_q", "", "alice", "politics", "t5_x", t, "08"))
    comments = prep.prep_comments(spark.createDataFrame(rows,
        "id string, link_id string, parent_id string, body string, author string, subreddit string, "
        "subreddit_id string, created_utc timestamp_ntz, month string"))
    plan = graph.post_join_plan(posts, comments)
    assert plan.n_posts == 2 and plan.hot is not None and plan.hot.count() == 1
    split = graph.comment_post_edges(posts, comments, plan=plan)
    plain = graph.comment_post_edges(posts, comments)
    assert split.count() == 7 and split.exceptAll(plain).count() == 0
