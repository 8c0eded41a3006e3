"""The pipeline over real month folders, as five steps and the season variant.

Each step reads the folder that the step before it wrote, so steps can be run
on their own and repeated.  Months are folders ``<dir>/<prefix>-<MM>``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.operators import counts, graph, motif, pagerank, prep, scc, triangles
from threadweave.operators.graph import PropertyGraph
from threadweave.plans import reports
from threadweave.runtime import partitions_for
from threadweave.schema import (
    MONTH_COL, PAGERANK_MAX_ITER, POLITICAL_SUBREDDITS, SCC_MAX_ITER, SCC_MAX_ITER_SEASON, SEASON_SUBREDDITS,
    TOP_COMPONENTS_PERIOD, TOP_COMPONENTS_SEASON, TOP_PAGERANK,
)
from threadweave.sources.monthly import read_month_folders, read_prepped
from threadweave.sources.sinks import read_stage, write_bucketed, write_csv, write_json, write_pair_text, write_parquet

POST_PREFIX, COMMENT_PREFIX = "RS_2016", "RC_2016"
POSTS, COMMENTS = "submissionPreppedDf", "commentPreppedDf"


def _at(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def prep_step(spark: SparkSession, posts_dir: str, comments_dir: str, months: Sequence[str] | str, output_dir: str,
              allow: Iterable[str] | None = POLITICAL_SUBREDDITS, post_prefix: str = POST_PREFIX,
              comment_prefix: str = COMMENT_PREFIX, id_mode: str = "hash") -> None:
    """Step 1: month folders -> cleaned, trimmed posts and comments with ids, partitioned by month."""
    posts = prep.prep_submissions(read_month_folders(spark, posts_dir, post_prefix, months), allow, id_mode)
    comments = prep.prep_comments(read_month_folders(spark, comments_dir, comment_prefix, months), allow, id_mode)
    write_parquet(posts, _at(output_dir, POSTS), partition_by_month=True)
    write_parquet(comments, _at(output_dir, COMMENTS), partition_by_month=True)


def graph_step(spark: SparkSession, prep_dir: str, output_dir: str, months: Sequence[str] | None = None,
               id_mode: str = "hash") -> None:
    """Step 2: prepped tables -> vertices and edges of the user graph and the
    property graph; edges bucketed by ``src``, by which step 3 weighs and counts them."""
    posts = read_prepped(spark, _at(prep_dir, POSTS), months)
    comments = read_prepped(spark, _at(prep_dir, COMMENTS), months)
    plan = graph.post_join_plan(posts.select("link_hash"), comments.select("link_hash"))
    users = graph.user_graph(posts, comments, plan)
    # a comment gives one edge at most, a post one
    n_comments = comments.count()
    write_parquet(users.vertices, _at(output_dir, "userVertices"))
    write_bucketed(users.edges, _at(output_dir, "userEdges"), ["src"], partitions_for(spark, n_comments))
    edges = spark.read.parquet(_at(output_dir, "userEdges"))
    write_parquet(graph.property_graph_vertices(posts, comments, id_mode), _at(output_dir, "propertyVertices"))
    write_bucketed(graph.property_graph_edges(posts, comments, edges), _at(output_dir, "propertyEdges"), ["src"],
                   partitions_for(spark, n_comments + plan.n_posts))


def read_graph(spark: SparkSession, graph_dir: str, kind: str) -> PropertyGraph:
    """``kind``: user or property."""
    return PropertyGraph(read_stage(spark, _at(graph_dir, f"{kind}Vertices")), read_stage(spark, _at(graph_dir, f"{kind}Edges")))


def algorithm_step(spark: SparkSession, graph_dir: str, output_dir: str, scc_rounds: int = SCC_MAX_ITER,
                   pagerank_rounds: int = PAGERANK_MAX_ITER) -> None:
    """Step 3: pair counts, components, PageRank vertices and edges of both graphs, and triangles."""
    for kind in ("user", "property"):
        g = read_graph(spark, graph_dir, kind)
        vertices, weighted = pagerank.pagerank(g, pagerank_rounds)
        write_parquet(vertices, _at(output_dir, f"{kind}PageRankVertices"))
        write_parquet(weighted, _at(output_dir, f"{kind}PageRankEdges"))
    users, prop = read_graph(spark, graph_dir, "user"), read_graph(spark, graph_dir, "property")
    write_parquet(scc.scc_labels(users, scc_rounds), _at(output_dir, "userComponents"))
    labels = spark.read.parquet(_at(output_dir, "userComponents"))
    write_parquet(scc.property_labels(labels, prop, scc_rounds).select("id", "component"), _at(output_dir, "propertyComponents"))
    write_parquet(counts.pair_counts(users.edges), _at(output_dir, "pairCounts"))
    write_parquet(counts.posting_counts(prop.edges), _at(output_dir, "postingCounts"))
    write_parquet(triangles.triangle_counts(users), _at(output_dir, "triangles"))


def report_step(spark: SparkSession, graph_dir: str, result_dir: str, output_dir: str, prep_dir: str | None = None,
                authors: Iterable[str] = ()) -> None:
    """Step 4: named reports; with ``prep_dir`` and ``authors`` also the subreddits
    that these authors comment in."""
    names = read_graph(spark, graph_dir, "property").vertices
    result = lambda name: spark.read.parquet(_at(result_dir, name))
    write_csv(reports.popular_pairs_named(result("pairCounts"), names), _at(output_dir, "popularPairs"))
    write_csv(reports.popular_pairs_named(result("postingCounts"), names), _at(output_dir, "popularPosters"))
    write_csv(reports.most_common_dst(result("pairCounts"), names), _at(output_dir, "mostCommonAuthors"))
    write_csv(reports.most_common_dst(result("postingCounts"), names), _at(output_dir, "mostCommonSubreddits"))
    write_csv(reports.pagerank_named(result("userPageRankVertices"), names), _at(output_dir, "userPageRank"))
    write_csv(result("propertyPageRankVertices").select("id", "name", "type", "pagerank").orderBy(F.desc("pagerank"), "id"),
              _at(output_dir, "propertyPageRank"))
    if prep_dir is not None and authors:
        chosen = counts.author_subreddit_counts(read_prepped(spark, _at(prep_dir, COMMENTS)), authors)
        write_csv(chosen.orderBy("author", F.desc("count"), "subreddit"), _at(output_dir, "authorSubreddits"))
    for kind in ("user", "property"):
        components = result(f"{kind}Components")
        write_csv(reports.component_sizes_named(components, names).orderBy(F.desc("count"), "component"),
                  _at(output_dir, f"{kind}ComponentSizes"))
        write_json(reports.component_members(components, names), _at(output_dir, f"{kind}ComponentMembers"))


def motif_step(spark: SparkSession, graph_dir: str, output_dir: str, posted_only: bool = False) -> None:
    """Step 5: the collaboration motif, one JSON line per match."""
    write_json(motif.motif_raw(read_graph(spark, graph_dir, "property"), posted_only), _at(output_dir, "collabMotif"))


def season_step(spark: SparkSession, posts_dir: str, comments_dir: str, months: Sequence[str] | str, output_dir: str,
                allow: Iterable[str] | None = SEASON_SUBREDDITS, post_prefix: str = POST_PREFIX, comment_prefix: str = COMMENT_PREFIX,
                season: str = "season") -> None:
    """Season variant: one graph per month and their union; components per
    graph and the largest of them, the comments of each month's largest
    component's author, PageRank and triangles of the union, and the pairs of
    commenter and post author over the season as text."""
    months = [m for m in months.split(",") if m] if isinstance(months, str) else list(months)
    period = lambda df: df.withColumnRenamed(MONTH_COL, "period")
    posts = period(prep.prep_season_posts(read_month_folders(spark, posts_dir, post_prefix, months), allow))
    comments = period(prep.prep_season_comments(read_month_folders(spark, comments_dir, comment_prefix, months), allow))
    keys = ["period", "link_hash", "auth_id"]
    g = graph.period_graph(posts.select(*keys), comments.select(*keys), months, season)
    write_parquet(g.vertices, _at(output_dir, "vertices"))
    write_parquet(g.edges, _at(output_dir, "edges"))
    g = PropertyGraph(spark.read.parquet(_at(output_dir, "vertices")), spark.read.parquet(_at(output_dir, "edges")), g.group)
    write_parquet(scc.scc_labels(g, SCC_MAX_ITER_SEASON), _at(output_dir, "components"))
    components = spark.read.parquet(_at(output_dir, "components"))
    most = F.when(F.col("period") == season, TOP_COMPONENTS_SEASON).otherwise(TOP_COMPONENTS_PERIOD)
    write_parquet(reports.top_components(components, "period", max(TOP_COMPONENTS_SEASON, TOP_COMPONENTS_PERIOD), most),
                  _at(output_dir, "topComponents"))
    top = reports.largest_component(components.filter(F.col("period") != season), "period").withColumnRenamed("component", "auth_id")
    write_parquet(comments.join(F.broadcast(top), ["period", "auth_id"]), _at(output_dir, "commentsOfTopAuthor"))   # one row a month
    write_pair_text(counts.commenter_op_counts(posts, comments).orderBy(F.desc("count"), "pair"), _at(output_dir, "pairCounts"))
    whole: list[DataFrame] = [df.filter(F.col("period") == season).drop("period") for df in (g.vertices, g.edges)]
    union = PropertyGraph(*whole)
    vertices, weighted = pagerank.pagerank(union, PAGERANK_MAX_ITER)
    write_parquet(vertices, _at(output_dir, "pageRankVertices"))
    write_parquet(weighted, _at(output_dir, "pageRankEdges"))
    ranks = spark.read.parquet(_at(output_dir, "pageRankVertices"))
    write_csv(reports.top_pagerank(ranks, TOP_PAGERANK), _at(output_dir, "topPageRank"))
    write_parquet(triangles.triangle_counts(union), _at(output_dir, "triangles"))
