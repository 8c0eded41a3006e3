"""Graph construction on DataFrames.

A graph is a pair of DataFrames: vertices with an ``id`` column and edges with
``src``/``dst``.  Optional *group* columns (e.g. ``period``) hold several
disjoint graphs in one pair of tables; every operator keys on
``group + [id]``, so all groups run in the same Spark jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.schema import REL_COMMENTED, REL_POSTED, TYPE_SUBREDDIT, TYPE_USER


@dataclass(frozen=True)
class PropertyGraph:
    vertices: DataFrame
    edges: DataFrame
    group: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        missing = [c for c in (*self.group, "id") if c not in self.vertices.columns]
        missing += [c for c in (*self.group, "src", "dst") if c not in self.edges.columns]
        if missing:
            raise ValueError(f"graph tables lack columns {missing}")

    @property
    def keys(self) -> list[str]:
        return [*self.group, "id"]


def user_vertices(posts: DataFrame, comments: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Distinct post authors and comment authors (authors without edges included)."""
    g = list(group)
    return (posts.select(*g, F.col("op_id").alias("id"))
            .union(comments.select(*g, F.col("auth_id").alias("id")))
            .distinct())


@dataclass(frozen=True)
class PostJoinPlan:
    """Sizes for the comment -> post join: post count and the hot post keys."""
    n_posts: int
    hot: DataFrame | None


def post_join_plan(posts: DataFrame, comments: DataFrame, group: Sequence[str] = ()) -> PostJoinPlan:
    """Count the posts and, if they are too many to broadcast (or to build in the
    driver), find the hot post keys (a viral post may carry a third of all comments) by counting the
    comments per key: at most maxHotKeys keys exceed
    max(minHotRows, comments / maxHotKeys), so the hot set has a proven bound.
    Both inputs are written tables of keys."""
    from threadweave.operators.joins import broadcast_ok, fits_driver, hot_keys
    from threadweave.runtime import cut
    n_posts, keys = posts.count(), posts.drop("author", "subreddit")   # names are not joined
    if broadcast_ok(keys, n_posts) and fits_driver(keys, n_posts):
        return PostJoinPlan(n_posts, None)
    hot = hot_keys(comments, [*group, "link_hash"], comments.count())
    return PostJoinPlan(n_posts, None if hot is None else cut(hot, "hot-posts"))


def comment_post_edges(posts: DataFrame, comments: DataFrame, group: Sequence[str] = (),
                       plan: PostJoinPlan | None = None) -> DataFrame:
    """One edge per comment: commenter (src) -> post author (dst); self-loops and
    parallel edges kept.  Inner join on the post key; comments on posts that
    were filtered out get no edge.

    With a ``plan`` the join is explicit about size and skew: all posts are
    broadcast when their count is under the broadcast bounds; otherwise hot
    posts (bounded set) join map-side and the rest by a shuffle join in which
    no post key exceeds the hot threshold.  Without a plan, AQE's skew join
    splits a hot post."""
    from threadweave.operators.joins import join_state
    g = list(group)
    c = comments.select(*g, "link_hash", F.col("auth_id").alias("src"))
    p = posts.select(*g, "link_hash", F.col("op_id").alias("dst"))
    if plan is None:
        return c.join(p, [*g, "link_hash"]).select(*g, "dst", "src")
    return join_state(c, p, [*g, "link_hash"], plan.n_posts, plan.hot).select(*g, "dst", "src")


def user_graph(posts: DataFrame, comments: DataFrame, plan: PostJoinPlan | None = None) -> PropertyGraph:
    return PropertyGraph(user_vertices(posts, comments), comment_post_edges(posts, comments, plan=plan))


def property_graph_vertices(posts: DataFrame, comments: DataFrame, id_mode: str = "hash") -> DataFrame:
    """(id, name, type): subreddits, post authors, comment authors; distinct.

    Takes cleaned posts and comments and reads their names only: the names are
    made distinct first and then given ids, so a name is hashed once."""
    from threadweave.operators.prep import with_hash
    subs = posts.select("subreddit").distinct()
    authors = posts.select("author").union(comments.select("author")).distinct()
    return (with_hash(subs, "subreddit", "id", id_mode)
            .select("id", F.col("subreddit").alias("name"), F.lit(TYPE_SUBREDDIT).alias("type"))
            .unionByName(with_hash(authors, "author", "id", id_mode)
                         .select("id", F.col("author").alias("name"), F.lit(TYPE_USER).alias("type"))))


def property_graph_edges(posts: DataFrame, comments: DataFrame, user_edges: DataFrame | None = None) -> DataFrame:
    """posted: user -> subreddit (one per post); commented: the user edges."""
    if user_edges is None:
        user_edges = comment_post_edges(posts, comments)
    posted = posts.select(F.col("op_id").alias("src"), F.col("sub_id").alias("dst"),
                          F.lit(REL_POSTED).alias("relationship"))
    commented = user_edges.select("src", "dst", F.lit(REL_COMMENTED).alias("relationship"))
    return posted.unionByName(commented)


def period_graph(posts: DataFrame, comments: DataFrame, periods: Sequence[str], season_label: str | None,
                 group: str = "period", plan: PostJoinPlan | None = None) -> PropertyGraph:
    """Per-period user graphs plus (optionally) their season union, as one grouped graph.

    ``posts``/``comments`` carry the ``group`` column and the season-variant
    ids (``auth_id`` on posts is the post author).  Each period's edges come
    from joining that period's comments and posts; the season graph is the
    union of the period graphs, its vertices de-duplicated.
    """
    p = posts.withColumnRenamed("auth_id", "op_id")
    v = user_vertices(p, comments, [group])
    e = comment_post_edges(p, comments, [group], plan)
    if season_label is not None:
        v = v.unionByName(v.select(F.lit(season_label).alias(group), "id").distinct())
        e = e.unionByName(e.select(F.lit(season_label).alias(group), "dst", "src"))
    return PropertyGraph(v, e, (group,))
