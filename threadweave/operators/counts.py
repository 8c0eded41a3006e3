"""Counting operators (all partial-aggregated before the shuffle)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.schema import REL_POSTED


def pair_counts(edges: DataFrame) -> DataFrame:
    """Parallel-edge multiplicity: (src, dst, count)."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("count"))


def posting_counts(property_edges: DataFrame) -> DataFrame:
    """Posts per (user, subreddit): the posted edges counted."""
    return pair_counts(property_edges.filter(F.col("relationship") == REL_POSTED))


def author_subreddit_counts(comments: DataFrame, authors: Iterable[str]) -> DataFrame:
    """Comments per subreddit for each chosen author."""
    return (comments.filter(F.col("author").isin(list(authors)))
            .groupBy("author", "subreddit").agg(F.count(F.lit(1)).alias("count")))


def commenter_op_counts(season_posts: DataFrame, season_comments: DataFrame) -> DataFrame:
    """How often each commenter writes in each author's threads, over the season.

    Posts and comments of all periods are joined on the post key (so a comment
    may sit in a later period than its post); key = ``"<commenter>,<op>"``.
    A hot post is split by AQE's skew join.
    """
    posts = season_posts.select("link_hash", F.col("author").alias("op"))
    com = season_comments.select("link_hash", "author")
    pairs = posts.join(com, "link_hash").select(F.concat(F.col("author"), F.lit(","), F.col("op")).alias("pair"))
    return pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
