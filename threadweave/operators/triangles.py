"""Triangle counting on DataFrames.

Semantics (GraphX triangle count behind the graph library call): direction is
ignored, parallel edges collapse, self-loops drop; every vertex gets the number of
triangles it lies on, 0 included.

Plan (edge iterator over a degree-ordered orientation):

1. canonical undirected edges {a, b}, a != b, distinct;
2. orient each edge from the lower to the higher (degree, id) end.  Then a
   vertex has at most sqrt(2m) out-edges - a hub's list is short - and a
   triangle is two out-edges (u, v), (u, w) of one vertex, v before w, that an
   edge (v, w) closes;
3. close the wedges by one of two plans, whichever moves fewer bytes (both counts
   are known before: wedges from the out-degrees, copies from the edges):

   * **blocks**: vertices are hashed to b blocks.  An edge goes to each triple
     of blocks that its two ends are in, so about b times; inside its triple an
     edge (u, v) whose third corner must be in block x meets the edges (u, w)
     with w in x, and the pair meets (v, w).  Every join there has the triple in
     its key, so all of them run where one shuffle has put the copies
     (``cut_placed``), and wedges never move.  b
     follows the counted edges (a triple of different blocks holds about
     6m / b^2 of them), so a task's share stays bounded;
   * **lists**: each head sends, along every out-edge (u, v), the part of its
     list after v to those v that have out-neighbours: one id per wedge at most;

4. each triangle adds 1 to its three corners (partial aggregation), then
   vertices without triangles get 0.

Skew: out-lists are bounded, but a hub can close many wedges.  In the block plan
its edges are spread over the blocks of their other ends; the counted largest
partition of copies decides between a hash join and a sort-merge join (which spills).  In
the list plan heads with more than T = m/1000 edges are hot; at most 1000 exist,
and a hot head's out-neighbours all have degree >= T, so its list has at most
2m/T = 2000 ids - the hot lists total at most 2M ids and are broadcast; other
heads join by a shuffle with at most T rows per key.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.operators.graph import PropertyGraph
from threadweave.operators.joins import hot_keys, join_state
from threadweave.runtime import CONF_LAYOUT_ROWS, conf_int, cut, cut_observed, cut_placed, partitions_for, session_conf

#: Bytes of the two plans, as measured on copies of the test tables: an edge's copy
#: is shuffled and written, a tail takes one id per wedge and a row per edge.
COPY_BYTES, ID_BYTES, TAIL_BYTES = 27, 4, 25

HOT_HEADS = 1000   # bound on hot heads; their out-lists total <= 2 * HOT_HEADS^2 ids


def undirected_simple_edges(edges: DataFrame, g: list[str]) -> DataFrame:
    return (edges.filter(F.col("src") != F.col("dst"))
            .select(*g, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
            .distinct())


@dataclass(frozen=True)
class Oriented:
    """Edges (group..., u, v, dv) from the lower to the higher (degree, id) end,
    dv the degree of v; written, with their count."""

    edges: DataFrame
    m: int
    group: list[str]


def oriented_edges(graph: PropertyGraph) -> Oriented:
    g = list(graph.group)
    und, _ = cut_observed(undirected_simple_edges(graph.edges, g), "tri-edges")
    deg = (und.select(*g, F.col("a").alias("id")).unionByName(und.select(*g, F.col("b").alias("id")))
           .groupBy(*g, "id").agg(F.count(F.lit(1)).alias("d")))
    da = deg.select(*g, F.col("id").alias("a"), F.col("d").alias("da"))
    db = deg.select(*g, F.col("id").alias("b"), F.col("d").alias("db"))
    # hub degrees: these two joins run outside any loop, where AQE splits hot keys
    a_first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    edges, mo = cut_observed(und.join(da, [*g, "a"]).join(db, [*g, "b"]).select(
        *g, F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("v"), F.greatest("da", "db").alias("dv")), "tri-oriented")
    return Oriented(edges, mo["rows"], g)


# ---- blocks ---------------------------------------------------------------------------------------

def n_blocks(spark: SparkSession, m: int) -> int:
    """Blocks for ``m`` edges: a triple's 6m / b^2 edges within the rows of a
    partition, and twice as many triples as tasks run at once."""
    b = max(1, ceil(sqrt(6 * m / conf_int(spark, CONF_LAYOUT_ROWS))))
    while b * (b + 1) * (b + 2) // 6 < 2 * spark.sparkContext.defaultParallelism:
        b += 1
    return b


def _block(id_: Column, b: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(b)).cast("int")


def block_edges(o: Oriented, b: int) -> DataFrame:
    """(group..., triple, third, u, v, dv, bv): each edge in each triple of blocks
    that its ends are in; ``third`` is the block left for the third corner."""
    third = F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("third")
    bu, bv = F.col("bu").cast("long"), F.col("bv").cast("long")
    x = F.col("third").cast("long")
    low, high = F.least(bu, bv, x), F.greatest(bu, bv, x)
    return (o.edges.withColumns({"bu": _block(F.col("u"), b), "bv": _block(F.col("v"), b)}).select("*", third)
            .select(*o.group, ((low * b + (bu + bv + x - low - high)) * b + high).alias("triple"), "third", "u", "v", "dv", "bv"))


def triangles_by_blocks(o: Oriented, b: int) -> DataFrame:
    """One row (group..., u, v, w) per triangle, by triples of blocks."""
    spark, g = o.edges.sparkSession, o.group
    triples = b * (b + 1) * (b + 2) // 6
    parts = max(partitions_for(spark, 2 * o.m * b), min(triples, 3 * spark.sparkContext.defaultParallelism))
    dealt, _ = cut_placed(block_edges(o, b).repartition(parts, *g, "triple"), "tri-blocks")
    most = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    # the build side of a hash join must fit: a task holds the edges of all its triples, twice
    join = "shuffle_hash" if most <= conf_int(spark, CONF_LAYOUT_ROWS) else "merge"
    first = dealt.select(*g, "triple", "u", F.col("bv").alias("x"), "v", "dv")
    second = dealt.select(*g, "triple", "u", F.col("third").alias("x"), F.col("v").alias("w"), F.col("dv").alias("dw"))
    closing = dealt.select(*g, "triple", F.col("u").alias("v"), F.col("v").alias("w"))
    ordered = (F.col("dv") < F.col("dw")) | ((F.col("dv") == F.col("dw")) & (F.col("v") < F.col("w")))
    wedges = first.join(second.hint(join), [*g, "triple", "u", "x"]).filter(ordered)
    return wedges.join(closing.hint(join), [*g, "triple", "v", "w"]).select(*g, "u", "v", "w")


# ---- lists ----------------------------------------------------------------------------------------

def wedge_tails(o: Oriented) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Out-lists (group..., u, nu), what heads send (group..., u, v, tail), and the hot middles."""
    g = o.group
    # out-lists in the (degree, id) order of the orientation: v's own triangles end at later ids only
    out_u, _ = cut_observed(o.edges.groupBy(*g, "u").agg(F.sort_array(F.collect_list(F.struct("dv", "v"))).alias("rs"))
                            .select(*g, "u", F.transform("rs", lambda r: r["v"]).alias("nu")), "tri-lists")
    tails = (out_u.filter(F.size("nu") > 1)
             .select(*g, "u", "nu", F.posexplode("nu").alias("p", "v")).filter(F.col("p") < F.size("nu") - 1)
             .select(*g, "u", "v", F.expr("slice(nu, p + 2, size(nu) - p - 1)").alias("tail")))
    return out_u, tails, hot_keys(o.edges, [*g, "v"], o.m, HOT_HEADS)


def triangles_by_lists(o: Oriented) -> DataFrame:
    """One row (group..., u, v, w) per triangle, by the tails of out-lists."""
    g = o.group
    lists, tails, hot = wedge_tails(o)
    out_v = lists.select(*g, F.col("u").alias("v"), F.col("nu").alias("nv"))
    # out-lists together hold one id per edge; what the driver builds of them has a row per head, too
    return (join_state(tails, out_v, [*g, "v"], lists.count(), hot, ids=o.m)
            .select(*g, "u", "v", F.explode(F.array_intersect("tail", "nv")).alias("w")))


def wedge_count(o: Oriented) -> int:
    out = o.edges.groupBy(*o.group, "u").agg(F.count(F.lit(1)).alias("d"))
    return int(out.agg(F.sum(F.expr("d * (d - 1) div 2"))).first()[0] or 0)


def blocks_move_less(spark: SparkSession, m: int, b: int, wedges: int) -> bool:
    """Whether copies to triples of blocks move less than tails; for a graph whose
    copies fit one partition, where little is moved, ids are compared."""
    if m * b <= conf_int(spark, CONF_LAYOUT_ROWS):
        return 2 * m * b < wedges
    return COPY_BYTES * m * b < ID_BYTES * wedges + TAIL_BYTES * m


#: Joins of the block plan use the partitioning by triple alone, as it was written.
BLOCK_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.enabled": "false"}


def corner_counts(triangles: DataFrame, g: list[str]) -> DataFrame:
    return (triangles.select(*g, F.explode(F.array("u", "v", "w")).alias("id"))
            .groupBy(*g, "id").agg(F.count(F.lit(1)).alias("count")))


def triangle_counts(graph: PropertyGraph) -> DataFrame:
    """(group..., id, count) for every distinct vertex id."""
    spark, g = graph.vertices.sparkSession, list(graph.group)
    keys = [*g, "id"]
    o = oriented_edges(graph)
    b = n_blocks(spark, o.m)
    if blocks_move_less(spark, o.m, b, wedge_count(o)):
        with session_conf(spark, BLOCK_CONF):
            per_vertex = cut(corner_counts(triangles_by_blocks(o, b), g), "tri-counts")
    else:
        per_vertex = corner_counts(triangles_by_lists(o), g)
    ids = graph.vertices.select(*keys).distinct()
    return ids.join(per_vertex, keys, "left").select(*keys, F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def triangle_count(graph: PropertyGraph) -> DataFrame:
    """Vertex rows (with attributes) plus ``count``."""
    return graph.vertices.join(triangle_counts(graph), graph.keys)
