"""PageRank, components and triangles against Spark's own graph library, called
on the same edge list through the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from threadweave.operators import pagerank, scc, triangles
from threadweave.operators.graph import PropertyGraph
from threadweave.plans.catalog import Pipeline
from threadweave.runtime import scratch_path
from threadweave.sources import fixture
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def graphs(spark):
    """The four-month user graph, here and in the library (vertices: ends of edges)."""
    p = Pipeline(spark, SF_MID)
    months = F.col("month").isin(*fixture.SLICE4_MONTHS)
    posts, comments = p.posts.filter(months), p.comments.filter(months)
    from threadweave.operators.graph import comment_post_edges
    path = scratch_path(spark, "graphx-edges")
    comment_post_edges(posts, comments).select(F.concat_ws(" ", "src", "dst")).write.text(path)
    edges = spark.read.text(path).select(*(F.split("value", " ")[i].cast("int").alias(c) for i, c in enumerate(("src", "dst"))))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    jvm = spark._jvm
    level = jvm.org.apache.spark.storage.StorageLevel.MEMORY_ONLY()
    library = jvm.org.apache.spark.graphx.GraphLoader.edgeListFile(spark._jsc.sc(), path, False, 4, level, level)
    return PropertyGraph(vertices, edges), library, jvm


def values(spark, library_graph, cast):
    path = scratch_path(spark, "graphx-result")
    library_graph.vertices().saveAsTextFile(path)
    out = {}
    for r in spark.read.text(path).collect():
        i, v = re.fullmatch(r"\((-?\d+),(.*)\)", r.value).groups()
        out[int(i)] = cast(v)
    return out


def int_tag(jvm):
    return getattr(jvm.scala.reflect.ClassTag, "Int")()


def test_pagerank(spark, graphs):
    g, library, jvm = graphs
    tag = int_tag(jvm)
    want = values(spark, jvm.org.apache.spark.graphx.lib.PageRank.run(library, 10, 0.15, tag, tag), float)
    got = {r.id: r.pagerank for r in pagerank.pagerank_ranks(g).collect()}
    assert got.keys() == want.keys() and len(got) > 300
    assert all(abs(got[i] - want[i]) < 1e-9 * max(1, want[i]) for i in want)


@pytest.mark.parametrize("rounds", [2, 10])
def test_components(spark, graphs, rounds):
    g, library, jvm = graphs
    tag = int_tag(jvm)
    want = values(spark, jvm.org.apache.spark.graphx.lib.StronglyConnectedComponents.run(library, rounds, tag, tag), int)
    got = {r.id: r.component for r in scc.scc_labels(g, rounds).collect()}
    assert got == want


def test_triangles(spark, graphs):
    g, library, jvm = graphs
    tag = int_tag(jvm)
    want = values(spark, jvm.org.apache.spark.graphx.lib.TriangleCount.run(library, tag, tag), int)
    got = {r.id: r["count"] for r in triangles.triangle_counts(g).collect()}
    assert got == want
