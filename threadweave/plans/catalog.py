"""Query catalog: every operator and report as ``(spark, sf_dir) -> DataFrame``.

Each query builds what it needs from the driver's tables through
``Pipeline`` (lazy, per call), so every query reads whole tables and its
work grows with them.  Doubles that go through a distributed sum are rounded
to 6 digits (summation order differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from threadweave import steps
from threadweave.functions import java_string_hash
from threadweave.operators import counts, graph, motif, pagerank, prep, scc, triangles
from threadweave.operators.graph import PropertyGraph
from threadweave.plans import reports
from threadweave.runtime import checkpoint_dir, cut, scratch_path, shuffle_by_rows
from threadweave.schema import (
    PAGERANK_MAX_ITER, SCC_MAX_ITER, SCC_MAX_ITER_SEASON, TOP_COMPONENTS_PERIOD, TOP_COMPONENTS_SEASON,
    TOP_PAGERANK,
)
from threadweave.sources import fixture, monthly, sinks
from threadweave.sources.fixture import SEASON_LABEL, SEASON_PERIODS
from threadweave.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


class Pipeline:
    """The stages of the original pipeline over one data directory.

    Prepped posts and comments are lazy; a query selects what it needs and
    Catalyst prunes the rest.  Where several branches of a plan read the same
    stage, the stage is written once to the shared checkpoint folder, with the
    columns that are read and no others: the keys of posts and comments for the
    graphs (``subreddits``: with the post's subreddit, for the property graph),
    and the distinct names.  ``named``: a query that reads both keys and names
    writes them together, and the names are taken from there.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, id_mode: str = "hash", subreddits: bool = False, named: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.id_mode = id_mode
        self.subreddits = subreddits
        self.named = named
        self._labels: dict[int, DataFrame] = {}
        checkpoint_dir(spark)

    # step 1: raw and prepped tables
    @cached_property
    def submissions_raw(self) -> DataFrame:
        return fixture.submissions_raw(self.spark, self.sf_dir)

    @cached_property
    def comments_raw(self) -> DataFrame:
        return fixture.comments_raw(self.spark, self.sf_dir)

    @property
    def posts(self) -> DataFrame:
        return prep.prep_submissions(self.submissions_raw, id_mode=self.id_mode)

    @property
    def comments(self) -> DataFrame:
        return prep.prep_comments(self.comments_raw, id_mode=self.id_mode)

    # step 2: graphs
    # (graph tables stay lazy: the iterative operators write their own inputs)
    @cached_property
    def post_keys(self) -> DataFrame:
        columns = ["link_hash", "op_id"] + ["sub_id"] * self.subreddits + ["author", "subreddit"] * self.named
        return cut(self.posts.select(*columns), "postKeys")

    @cached_property
    def comment_keys(self) -> DataFrame:
        return cut(self.comments.select("link_hash", "auth_id", *["author"] * self.named), "commentKeys")

    @cached_property
    def user_graph(self) -> PropertyGraph:
        plan = graph.post_join_plan(self.post_keys, self.comment_keys)
        return graph.user_graph(self.post_keys, self.comment_keys, plan)

    @cached_property
    def names(self) -> DataFrame:
        return cut(self.vertices, "names")

    @property
    def vertices(self) -> DataFrame:
        if self.named:
            return graph.property_graph_vertices(self.post_keys, self.comment_keys, self.id_mode)
        return graph.property_graph_vertices(prep.clean_submissions(self.submissions_raw),
                                             prep.clean_comments(self.comments_raw), self.id_mode)

    @cached_property
    def property_graph(self) -> PropertyGraph:
        posts = self.post_keys if self.subreddits else self.posts
        return PropertyGraph(self.names, graph.property_graph_edges(posts, self.comment_keys, self.user_graph.edges))

    # season variant: three periods and their union
    def season_rows(self, df: DataFrame) -> DataFrame:
        start, end = fixture.periods_span(SEASON_PERIODS)
        return df.filter(fixture.in_range(start, end)).withColumn("period", fixture.period_label(SEASON_PERIODS))

    def season_posts(self, allow: Iterable[str] | None = None) -> DataFrame:
        return prep.prep_season_posts(self.season_rows(self.submissions_raw), allow, id_mode=self.id_mode)

    def season_comments(self, allow: Iterable[str] | None = None) -> DataFrame:
        return prep.prep_season_comments(self.season_rows(self.comments_raw), allow, id_mode=self.id_mode)

    @cached_property
    def period_graph(self) -> PropertyGraph:
        posts = cut(self.season_posts().select("period", "link_hash", "auth_id"), "seasonPostKeys")
        comments = cut(self.season_comments().select("period", "link_hash", "auth_id"), "seasonCommentKeys")
        plan = graph.post_join_plan(posts, comments, ["period"])
        return graph.period_graph(posts, comments, list(SEASON_PERIODS), SEASON_LABEL, plan=plan)

    @cached_property
    def season_graph(self) -> PropertyGraph:
        pg = self.period_graph
        return PropertyGraph(pg.vertices.filter(F.col("period") == SEASON_LABEL).drop("period"),
                             pg.edges.filter(F.col("period") == SEASON_LABEL).drop("period"))

    # step 3: algorithms
    @cached_property
    def pairs(self) -> DataFrame:
        return counts.pair_counts(self.user_graph.edges)

    @cached_property
    def posting_pairs(self) -> DataFrame:
        """Posts per (user, subreddit), straight from the posts."""
        return counts.pair_counts(self.posts.select(F.col("op_id").alias("src"), F.col("sub_id").alias("dst")))

    def scc_users(self, max_iter: int = SCC_MAX_ITER) -> DataFrame:
        """Labels of the user graph; one run per pipeline and round limit."""
        if max_iter not in self._labels:
            self._labels[max_iter] = cut(scc.scc_labels(self.user_graph, max_iter), "userComponents")
        return self._labels[max_iter]

    def scc_property(self, max_iter: int = SCC_MAX_ITER) -> DataFrame:
        """Labels of the property graph, from those of the user graph."""
        return scc.property_labels(self.scc_users(max_iter), self.property_graph, max_iter)


def _r6(col: str) -> F.Column:
    return F.round(F.col(col), 6).alias(col)


# ---- step 1: sources, filters, prep -------------------------------------------------------------

def q_load_months(spark, sf):
    """Raw posts of four months, written as month folders and read back from them."""
    base = scratch_path(spark, "months")
    monthly.write_month_folders(Pipeline(spark, sf).submissions_raw, base, "RS", fixture.SLICE4_MONTHS)
    return monthly.read_month_folders(spark, base, "RS", fixture.SLICE4_MONTHS)


def q_season_from_folders(spark, sf):
    """Components of the season variant, run over the folders of its fixed months."""
    p, base = Pipeline(spark, sf), scratch_path(spark, "season")
    for df, prefix in ((p.submissions_raw, "RS_2016"), (p.comments_raw, "RC_2016")):
        months = p.season_rows(df).drop("month").withColumnRenamed("period", "month")
        monthly.write_month_folders(months, f"{base}/raw", prefix, list(SEASON_PERIODS))
    steps.season_step(spark, f"{base}/raw", f"{base}/raw", list(SEASON_PERIODS), f"{base}/out", allow=None, season=SEASON_LABEL)
    return spark.read.parquet(f"{base}/out/components")


def q_remove_deleted_authors(spark, sf):
    return prep.remove_deleted_authors(Pipeline(spark, sf).submissions_raw)


def q_remove_zero_comment_posts(spark, sf):
    return prep.remove_zero_comment_posts(Pipeline(spark, sf).submissions_raw)


def q_filter_subreddits(spark, sf):
    return prep.filter_subreddits(Pipeline(spark, sf).submissions_raw, fixture.FIXTURE_ALLOW_LIST)


def q_trim_submissions(spark, sf):
    return Pipeline(spark, sf).posts


def q_trim_comments(spark, sf):
    return Pipeline(spark, sf).comments


def q_trim_season(spark, sf):
    return Pipeline(spark, sf).season_comments()


def q_season_prep_allowed(spark, sf):
    return Pipeline(spark, sf).season_posts(fixture.FIXTURE_ALLOW_LIST)


def q_java_string_hash(spark, sf):
    raw = Pipeline(spark, sf).submissions_raw
    return raw.select("name", java_string_hash("name").alias("name_hash"),
                      "author", java_string_hash("author").alias("author_hash"),
                      "subreddit", java_string_hash("subreddit").alias("subreddit_hash"))


# ---- step 2: graphs -----------------------------------------------------------------------------

def q_user_vertices(spark, sf):
    return Pipeline(spark, sf).user_graph.vertices


def q_comment_post_edges(spark, sf):
    return Pipeline(spark, sf).user_graph.edges


def q_property_graph_vertices(spark, sf):
    return Pipeline(spark, sf).vertices


def q_property_graph_edges(spark, sf):
    p = Pipeline(spark, sf, subreddits=True)
    return graph.property_graph_edges(p.post_keys, p.comment_keys, p.user_graph.edges)


def q_season_union(spark, sf):
    """Edges of the period graphs and of their season union (period = 'season')."""
    return Pipeline(spark, sf).period_graph.edges


def q_id_collisions(spark, sf):
    """Ids that name more than one (name, type) — hash collisions in the id space."""
    return Pipeline(spark, sf).vertices.groupBy("id").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


# ---- step 3: counts and count reports -----------------------------------------------------------

def q_popular_pairs(spark, sf):
    return Pipeline(spark, sf).pairs.orderBy(F.desc("count"), "src", "dst")


def q_user_post_subreddit_counts(spark, sf):
    return Pipeline(spark, sf).posting_pairs.orderBy(F.desc("count"), "src", "dst")


def q_popular_pairs_named(spark, sf):
    p = Pipeline(spark, sf)
    return reports.popular_pairs_named(p.pairs, p.names)


def q_popular_posters_named(spark, sf):
    p = Pipeline(spark, sf)
    return reports.popular_pairs_named(p.posting_pairs, p.names)


def q_most_common_dst(spark, sf):
    p = Pipeline(spark, sf)
    return reports.most_common_dst(p.pairs, p.names)


def q_most_common_subreddit(spark, sf):
    p = Pipeline(spark, sf)
    return reports.most_common_dst(p.posting_pairs, p.names)


def q_author_subreddit_counts(spark, sf):
    return counts.author_subreddit_counts(prep.clean_comments(Pipeline(spark, sf).comments_raw), fixture.FIXTURE_AUTHORS)


def q_pair_counts_text(spark, sf):
    p = Pipeline(spark, sf)
    return counts.commenter_op_counts(p.season_posts(), p.season_comments()).orderBy(F.desc("count"), "pair")


# ---- step 4: PageRank ---------------------------------------------------------------------------

def q_pagerank_users(spark, sf):
    ranks = pagerank.pagerank_ranks(Pipeline(spark, sf).user_graph, PAGERANK_MAX_ITER)
    return ranks.select("id", _r6("pagerank"))


def _weights(g: PropertyGraph) -> DataFrame:
    return pagerank.edge_weights(PropertyGraph(g.vertices, cut(g.edges, "weighted-edges")))


def q_pagerank_edge_weights(spark, sf):
    return _weights(Pipeline(spark, sf).user_graph)


def q_pagerank_property_graph(spark, sf):
    vertices, _ = pagerank.pagerank(Pipeline(spark, sf, subreddits=True).property_graph, PAGERANK_MAX_ITER)
    return vertices.select("id", "name", "type", _r6("pagerank")).orderBy(F.desc("pagerank"), "id")


def q_pagerank_property_edges(spark, sf):
    p = Pipeline(spark, sf, subreddits=True)
    edges = graph.property_graph_edges(p.post_keys, p.comment_keys, p.user_graph.edges)
    return _weights(PropertyGraph(p.user_graph.vertices, edges)).select("src", "dst", "relationship", "weight")


def q_season_pagerank(spark, sf):
    return pagerank.pagerank_ranks(Pipeline(spark, sf).season_graph, PAGERANK_MAX_ITER).select("id", _r6("pagerank"))


def q_season_pagerank_edges(spark, sf):
    return _weights(Pipeline(spark, sf).season_graph)


def q_pagerank_users_named(spark, sf):
    p = Pipeline(spark, sf, named=True)
    ranks = pagerank.pagerank_ranks(p.user_graph, PAGERANK_MAX_ITER).select("id", _r6("pagerank"))
    return reports.pagerank_named(ranks, p.names)


def q_top_pagerank(spark, sf):
    ranks = pagerank.pagerank_ranks(Pipeline(spark, sf).season_graph, PAGERANK_MAX_ITER)
    return reports.top_pagerank(ranks.select("id", _r6("pagerank")), TOP_PAGERANK)


# ---- step 5: strongly connected components ------------------------------------------------------

def q_scc_users(spark, sf):
    return Pipeline(spark, sf).scc_users(SCC_MAX_ITER)


def q_scc_bounded(spark, sf):
    return Pipeline(spark, sf).scc_users(SCC_MAX_ITER_SEASON)


def q_scc_property_graph(spark, sf):
    return Pipeline(spark, sf, subreddits=True).scc_property(SCC_MAX_ITER)


def q_scc_monthly(spark, sf):
    return scc.scc_labels(Pipeline(spark, sf).period_graph, SCC_MAX_ITER_SEASON)


def _both_graphs(p: Pipeline) -> list[tuple[str, DataFrame]]:
    return [("users", p.scc_users(SCC_MAX_ITER)),
            ("property", p.scc_property(SCC_MAX_ITER).drop("name", "type"))]


def q_scc_component_sizes(spark, sf):
    p = Pipeline(spark, sf, subreddits=True)
    parts = [reports.component_sizes_named(s, p.names).select(F.lit(name).alias("graph"), "*")
             for name, s in _both_graphs(p)]
    return parts[0].unionByName(parts[1]).orderBy("graph", F.desc("count"), "component")


def q_scc_component_members(spark, sf):
    p = Pipeline(spark, sf, subreddits=True)
    parts = [reports.component_members(s, p.names).select(F.lit(name).alias("graph"), "*")
             for name, s in _both_graphs(p)]
    return parts[0].unionByName(parts[1]).orderBy("graph", F.desc("count"), "component", "member")


def q_top_components(spark, sf):
    labels = scc.scc_labels(Pipeline(spark, sf).period_graph, SCC_MAX_ITER_SEASON)
    k = F.when(F.col("period") == SEASON_LABEL, TOP_COMPONENTS_SEASON).otherwise(TOP_COMPONENTS_PERIOD)
    return reports.top_components(labels, "period", max(TOP_COMPONENTS_SEASON, TOP_COMPONENTS_PERIOD), k)


def q_comments_of_top_author(spark, sf):
    p = Pipeline(spark, sf)
    labels = scc.scc_labels(p.period_graph, SCC_MAX_ITER_SEASON).filter(F.col("period") != SEASON_LABEL)
    top = reports.largest_component(labels, "period").withColumnRenamed("component", "auth_id")
    return (p.season_comments().join(F.broadcast(top), ["period", "auth_id"])   # one row for each of the listed periods
            .select("period", "author", "id", "link_id", "subreddit", "created_utc", "link_hash", "auth_id"))


# ---- step 6: motif and triangles ----------------------------------------------------------------

def q_motif_collab(spark, sf):
    return motif.motif_raw(Pipeline(spark, sf, subreddits=True).property_graph)


def _count_text(df: DataFrame) -> DataFrame:
    # multiplicities outgrow 64 bits; as text they compare alike in any engine
    return df.withColumn("matches", F.col("matches").cast("string"))


def q_motif_collab_distinct(spark, sf):
    return _count_text(motif.motif_distinct(Pipeline(spark, sf, subreddits=True).property_graph))


def q_motif_posted_only(spark, sf):
    return _count_text(motif.motif_distinct(Pipeline(spark, sf, subreddits=True).property_graph, posted_only=True))


def q_triangle_count(spark, sf):
    return triangles.triangle_counts(Pipeline(spark, sf).user_graph)


def q_season_triangles(spark, sf):
    return triangles.triangle_counts(Pipeline(spark, sf).season_graph)


def q_triangles_named(spark, sf):
    p = Pipeline(spark, sf, named=True)
    return (triangles.triangle_counts(p.user_graph).join(p.names.select("id", "name", "type"), "id")
            .orderBy(F.desc("count"), "id"))


# ---- step 7: sinks (written to the shared folder, read back) -------------------------------------

def q_stage_roundtrip(spark, sf):
    comments = Pipeline(spark, sf).comments
    path = scratch_path(spark, "commentPrepped")
    # a task sorts its whole rows by month, so the tasks follow the rows (a comment is a line item)
    with shuffle_by_rows(spark, read_table(spark, sf, "lineitem").count()):
        sinks.write_parquet(comments, path, partition_by_month=True)
    return spark.read.parquet(path).select(*comments.columns)


PAIRS_NAMED_SCHEMA = StructType([
    StructField("dst", IntegerType()), StructField("src", IntegerType()), StructField("count", LongType()),
    StructField("src_name", StringType()), StructField("src_type", StringType()),
    StructField("dst_name", StringType()), StructField("dst_type", StringType()),
])
MOTIF_SCHEMA = StructType([
    StructField("user1", StringType()), StructField("subreddit1", StringType()),
    StructField("subreddit2", StringType()), StructField("user2", StringType()),
])


def q_csv_export(spark, sf):
    path = sinks.write_csv(q_popular_pairs_named(spark, sf), scratch_path(spark, "popularPairCsv"))
    return spark.read.schema(PAIRS_NAMED_SCHEMA).option("header", "false").csv(path)


def q_json_export(spark, sf):
    path = sinks.write_json(q_motif_collab(spark, sf), scratch_path(spark, "collabMotifJson"))
    return spark.read.schema(MOTIF_SCHEMA).json(path)


def q_text_export(spark, sf):
    path = sinks.write_pair_text(q_pair_counts_text(spark, sf), scratch_path(spark, "pairCountsText"))
    return spark.read.text(path)


QUERIES: dict[str, Query] = {
    "load_months": q_load_months,
    "season_from_folders": q_season_from_folders,
    "remove_deleted_authors": q_remove_deleted_authors,
    "remove_zero_comment_posts": q_remove_zero_comment_posts,
    "filter_subreddits": q_filter_subreddits,
    "trim_submissions": q_trim_submissions,
    "trim_comments": q_trim_comments,
    "trim_season": q_trim_season,
    "season_prep_allowed": q_season_prep_allowed,
    "java_string_hash": q_java_string_hash,
    "user_vertices": q_user_vertices,
    "comment_post_edges": q_comment_post_edges,
    "property_graph_vertices": q_property_graph_vertices,
    "property_graph_edges": q_property_graph_edges,
    "season_union": q_season_union,
    "id_collisions": q_id_collisions,
    "popular_pairs": q_popular_pairs,
    "user_post_subreddit_counts": q_user_post_subreddit_counts,
    "popular_pairs_named": q_popular_pairs_named,
    "popular_posters_named": q_popular_posters_named,
    "most_common_dst": q_most_common_dst,
    "most_common_subreddit": q_most_common_subreddit,
    "author_subreddit_counts": q_author_subreddit_counts,
    "pair_counts_text": q_pair_counts_text,
    "pagerank_users": q_pagerank_users,
    "pagerank_edge_weights": q_pagerank_edge_weights,
    "pagerank_property_graph": q_pagerank_property_graph,
    "pagerank_property_edges": q_pagerank_property_edges,
    "season_pagerank": q_season_pagerank,
    "season_pagerank_edges": q_season_pagerank_edges,
    "pagerank_users_named": q_pagerank_users_named,
    "top_pagerank": q_top_pagerank,
    "scc_users": q_scc_users,
    "scc_bounded": q_scc_bounded,
    "scc_property_graph": q_scc_property_graph,
    "scc_monthly": q_scc_monthly,
    "scc_component_sizes": q_scc_component_sizes,
    "scc_component_members": q_scc_component_members,
    "top_components": q_top_components,
    "comments_of_top_author": q_comments_of_top_author,
    "motif_collab": q_motif_collab,
    "motif_collab_distinct": q_motif_collab_distinct,
    "motif_posted_only": q_motif_posted_only,
    "season_triangles": q_season_triangles,
    "triangle_count": q_triangle_count,
    "triangles_named": q_triangles_named,
    "stage_roundtrip": q_stage_roundtrip,
    "csv_export": q_csv_export,
    "json_export": q_json_export,
    "text_export": q_text_export,
}
