"""Named reports over the algorithm results (the user-visible outputs).

Sorts are the last step of a report (a sort under a join or union is removed by
the optimizer; the two component reports are sorted where their graphs are
united), ties are broken by id, and top-k uses a window with a
row-number limit, which Spark plans as a per-partition group limit before
the shuffle, so no group is gathered whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadweave.schema import COMPONENT_MIN_SIZE, PAIR_MIN_COUNT


def _names(vertices: DataFrame, key: str, prefix: str = "") -> DataFrame:
    return vertices.select(F.col("id").alias(key), F.col("name").alias(f"{prefix}name"),
                           F.col("type").alias(f"{prefix}type"))


def component_sizes(scc: DataFrame, min_size: int = COMPONENT_MIN_SIZE) -> DataFrame:
    """(component, count) of components with more than ``min_size`` members."""
    return (scc.groupBy("component").agg(F.count(F.lit(1)).alias("count"))
            .filter(F.col("count") > min_size))


def component_sizes_named(scc: DataFrame, names: DataFrame, min_size: int = COMPONENT_MIN_SIZE) -> DataFrame:
    """Sizes labelled by the vertex whose id is the component label."""
    return component_sizes(scc, min_size).join(_names(names, "component"), "component")


def component_members(scc: DataFrame, names: DataFrame, min_size: int = COMPONENT_MIN_SIZE) -> DataFrame:
    """Member names of each component with more than ``min_size`` members, in
    long form: one row (component, count, member, name, type) per component and
    distinct member name, with the label vertex's name and type.

    The members of a component are never gathered, so a giant component is
    many rows like any other; its hot key meets one row on the other side."""
    labelled = component_sizes(scc, min_size).join(_names(names, "component"), "component")
    members = (scc.select("id", "component").join(names.select("id", F.col("name").alias("member")), "id")
               .select("component", "member").distinct())
    return members.join(labelled, "component").select("component", "count", "member", "name", "type")


def pagerank_named(ranks: DataFrame, names: DataFrame) -> DataFrame:
    return ranks.join(names.select("id", "name", "type"), "id").orderBy(F.desc("pagerank"), "id")


def popular_pairs_named(pairs: DataFrame, names: DataFrame, min_count: int = PAIR_MIN_COUNT) -> DataFrame:
    """Pairs seen more than ``min_count`` times, no self pairs, with both names."""
    return (pairs.filter((F.col("count") > min_count) & (F.col("src") != F.col("dst")))
            .join(_names(names, "src", "src_"), "src")
            .join(_names(names, "dst", "dst_"), "dst")
            .select("dst", "src", "count", "src_name", "src_type", "dst_name", "dst_type")
            .orderBy(F.desc("count"), "src", "dst"))


def most_common_dst(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct partners per destination, named (self pairs included)."""
    per_dst = pairs.groupBy("dst").agg(F.count(F.lit(1)).alias("count"))
    return (per_dst.join(names.withColumnRenamed("id", "dst"), "dst")
            .select("dst", "count", "name", "type").orderBy(F.desc("count"), "dst"))


def top_by_group(df: DataFrame, group: str, order: list, k_max: int, k_col=None) -> DataFrame:
    """Top rows per group with ``row_number() <= k``.

    The window filter uses the literal ``k_max`` so Spark plans a partial
    ``WindowGroupLimit`` before the shuffle (each task keeps at most k_max rows
    per group); a per-group ``k_col`` (<= k_max) is applied after that."""
    w = Window.partitionBy(group).orderBy(*order)
    top = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k_max)
    return top if k_col is None else top.filter(F.col("rank") <= k_col)


def top_components(scc_grouped: DataFrame, group: str, k_max: int, k_for_group=None) -> DataFrame:
    """(group, rank, component, count): the largest components per group."""
    sizes = scc_grouped.groupBy(group, "component").agg(F.count(F.lit(1)).alias("count"))
    return (top_by_group(sizes, group, [F.desc("count"), "component"], k_max, k_for_group)
            .select(group, "rank", "component", "count").orderBy(group, "rank"))


def largest_component(scc_grouped: DataFrame, group: str) -> DataFrame:
    """(group, component): label of the largest component per group (ties: smallest label).

    A min over a struct — partial-aggregated, never a whole group in a task.
    """
    sizes = scc_grouped.groupBy(group, "component").agg(F.count(F.lit(1)).alias("count"))
    best = sizes.groupBy(group).agg(F.min(F.struct((-F.col("count")).alias("neg"), F.col("component"))).alias("b"))
    return best.select(group, F.col("b.component").alias("component"))


def top_pagerank(ranks: DataFrame, k: int) -> DataFrame:
    """Top-k ranks (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return ranks.orderBy(F.desc(F.round("pagerank", 6)), "id").limit(k)


