"""Static PageRank on DataFrames.

Semantics (GraphX static PageRank, as called with maxIter and the default
reset probability 0.15): every vertex starts at 1.0; each round
``r(v) = 0.15 + 0.85 * sum(r(u) * n(u,v) / outdeg(u))`` over in-edges, with
parallel edges counted in both the sum and the out-degree (self-loops too);
vertices without in-edges get 0.15.  After the last round ranks are scaled so
they sum to the number of vertices (rank mass lost at sinks is restored).
Edge weight = 1 / outdeg(src).

Plan: parallel edges are collapsed to (src, dst, w).  While the vertex count
allows, they are laid out by ``dst`` and kept, and a round broadcasts the ranks:
the sums are made where the edges lie, and nothing is shuffled.  A hot target has
at most one edge per vertex there, so no more than the broadcast bound.  Beyond
that, edges are collapsed while they are laid out by ``src`` (``joins.lay_out``;
hot sources apart), the only time they move, ranks stay partitioned by vertex
(``cut_placed``) like the edges, and a round moves the sums per ``dst`` only,
combined in the tasks before.  The ranks are written every ``threadweave.iter.checkpointEvery`` rounds (every round where hot
sources read them twice) and their predecessor is deleted, so lineage stays
short and a lost executor only recomputes the current rounds.  The number of
partitions follows the counted edges.  Vertices without in-edges are re-added at
the end.
"""

from __future__ import annotations

from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.operators.graph import PropertyGraph
from threadweave.operators.joins import EdgeLayout, broadcast_ok, lay_out
from threadweave.runtime import (
    CONF_CHECKPOINT_EVERY, CONF_LAYOUT_ROWS, conf_int, cut_observed, cut_placed, loop_conf, partitions_for, replace_table,
)
from threadweave.schema import PAGERANK_MAX_ITER, PAGERANK_RESET


def out_degrees(edges: DataFrame, group: list[str]) -> DataFrame:
    return edges.groupBy(*group, "src").agg(F.count(F.lit(1)).alias("outdeg"))


def edge_weights(graph: PropertyGraph) -> DataFrame:
    """Every edge row with ``weight = 1/outdeg(src)``.  The edges are read twice,
    so they should be a written table."""
    g = list(graph.group)
    deg = out_degrees(graph.edges, g)
    return graph.edges.join(deg, [*g, "src"]).withColumn("weight", 1.0 / F.col("outdeg")).drop("outdeg")


def collapsed_weights(edges: DataFrame, g: list[str]) -> DataFrame:
    """(group..., src, dst, w) of edges whose sources are whole: w = n(src, dst) / outdeg(src)."""
    pairs = edges.groupBy(*g, "src", "dst").agg(F.count(F.lit(1)).alias("n"))
    outdeg = pairs.groupBy(*g, "src").agg(F.sum("n").alias("outdeg"))
    return pairs.join(outdeg, [*g, "src"]).select(*g, "src", "dst", (F.col("n") / F.col("outdeg")).alias("w"))


def weights_by_target(edges: DataFrame, g: list[str], n_edges: int) -> EdgeLayout:
    """``collapsed_weights`` laid out by target, for ranks within the broadcast
    bound: out-degrees are broadcast, and the sum per target needs no exchange.
    Parallel edges are collapsed before, so a target has one edge per vertex at most."""
    spark = edges.sparkSession
    parts = max(partitions_for(spark, n_edges), ceil(4 * n_edges / conf_int(spark, CONF_LAYOUT_ROWS)))
    outdeg = F.broadcast(out_degrees(edges, g))
    w = (edges.groupBy(*g, "src", "dst").agg(F.count(F.lit(1)).alias("n")).join(outdeg, [*g, "src"])
         .select(*g, "src", "dst", (F.col("n") / F.col("outdeg")).alias("w")))
    return EdgeLayout([*g, "src"], w.repartition(parts, *g, "dst").persist(StorageLevel.MEMORY_AND_DISK), kept=True)


def rank_round(by_src: EdgeLayout, ranks: DataFrame | None, n_vertices: int, g: list[str], reset: float) -> DataFrame:
    """Ranks (group..., id, pagerank) after one more round, of vertices with
    in-edges.  Only they are stored: any other vertex has rank ``reset`` after the
    first round, so a missing row reads as that.  The first round (``ranks`` None)
    needs no join, as every rank is 1.0."""
    if ranks is None:
        contrib = by_src.all_edges().withColumn("pagerank", F.lit(1.0))
    else:
        contrib = (by_src.join(ranks.withColumnRenamed("id", "src"), n_vertices, "left")
                   .withColumn("pagerank", F.coalesce(F.col("pagerank"), F.lit(reset))))
    total = F.sum(F.col("pagerank") * F.col("w"))
    return (contrib.groupBy(*g, F.col("dst").alias("id"))
            .agg((F.lit(reset) + F.lit(1.0 - reset) * total).alias("pagerank")))


def pagerank_ranks(graph: PropertyGraph, max_iter: int = PAGERANK_MAX_ITER,
                   reset: float = PAGERANK_RESET) -> DataFrame:
    """(group..., id, pagerank) for every distinct vertex id."""
    spark = graph.vertices.sparkSession
    g = list(graph.group)
    keys = [*g, "id"]
    ids, mv = cut_observed(graph.vertices.select(*keys).distinct(), "pagerank-ids")
    n_vertices = mv["rows"]   # bounds every rank table (ranks are a subset of ids)
    small = broadcast_ok(ids, n_vertices)
    edges, me = cut_observed(graph.edges.select(*g, "src", "dst"), "pagerank-edges")
    ranks, path = None, None
    with loop_conf(spark, max(me["rows"], n_vertices)):
        if small:
            by_src = weights_by_target(edges, g, me["rows"])
        else:
            by_src = lay_out(edges, [*g, "src"], me["rows"], n_vertices, lambda df: collapsed_weights(df, g))
        every = max(1, conf_int(spark, CONF_CHECKPOINT_EVERY)) if by_src.hot is None else 1
        for i in range(max_iter):
            ranks = rank_round(by_src, ranks, n_vertices, g, reset)
            if (i + 1) % every == 0 or i + 1 == max_iter:
                ranks, mr = cut_placed(ranks, "pagerank-ranks")
                path = replace_table(spark, path, mr["path"])
        by_src.release()

    first = 1.0 if max_iter == 0 else reset
    full = ids.join(ranks, keys, "left") if ranks is not None else ids.withColumn("pagerank", F.lit(None))
    full = full.withColumn("pagerank", F.coalesce(F.col("pagerank"), F.lit(first)))
    totals = full.groupBy(*g).agg(F.sum("pagerank").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    if g:
        scaled = full.join(totals, g)   # one row per group; Spark broadcasts it if it is small
    else:
        row = totals.first()
        scaled = full.withColumn("_sum", F.lit(row["_sum"])).withColumn("_n", F.lit(row["_n"]))
    return scaled.select(*keys, (F.col("pagerank") * F.col("_n") / F.col("_sum")).alias("pagerank"))


def pagerank(graph: PropertyGraph, max_iter: int = PAGERANK_MAX_ITER,
             reset: float = PAGERANK_RESET) -> tuple[DataFrame, DataFrame]:
    """(vertices + pagerank, edges + weight), like the graph library's result."""
    ranks = pagerank_ranks(graph, max_iter, reset)
    vertices = graph.vertices.join(ranks, graph.keys)
    return vertices, edge_weights(graph)
