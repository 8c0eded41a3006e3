"""Strongly connected components on DataFrames, with a round limit.

Semantics (GraphX's ``StronglyConnectedComponents.run(graph, maxIter)``, the
algorithm behind the graph library call): the component label is the
smallest vertex id of the component (signed compare).  One outer round:

1. *trim until stable* — a work vertex without an in-edge or without an
   out-edge inside the work graph is settled as its own component (a
   self-loop counts as both);
2. *colour* — every work vertex takes the minimum id among itself and its
   ancestors in the work graph;
3. *backward sweep* — a vertex whose colour is its own id is a root; vertices
   of that colour that reach it through same-colour vertices are settled with
   that colour.

Colouring runs only while the round number is below ``max_iter``, so
``max_iter=k`` performs k-1 colourings; unsettled vertices keep their own id
(so do trimmed ones — only sweep results need recording).  ``max_iter=2`` is
therefore a partial answer, not full SCC.

Plan: each phase is a frontier iteration with one written state per step (counted
by ``observe`` in the same job, its predecessor deleted); all three steps are
monotone, so steps after convergence change nothing:

* trimming peels a frontier of dead vertices and decrements the degrees of
  their neighbours (work ~ edges touching the frontier, not the whole graph);
* colouring pushes only changed colours along out-edges (Pregel-style);
* the sweep pushes the colours of newly settled vertices backward; a vertex is
  settled by a message of its own colour.

States stay partitioned by vertex (``cut_placed``).  While the vertices fit the
broadcast bound, the edges are written once, and again with both ends in the
work set after each round, and meet broadcast frontiers.  Beyond it the edges
are laid out by ``src`` and by ``dst`` once for all rounds
(``joins.GraphLayout``: hot sources and hot targets apart), like the states, and
parallel edges are collapsed where they lie.  A step then moves messages only -
combined in the tasks - and neither edges nor states.  A message needs no check of its
receiver: one that is no longer in the work set has no row that it could change.

Most steps run on the few vertices that the first ones leave, so the edges shrink
with the work set (``Ground``): as often as it has fallen to a quarter, edges of
other vertices are dropped (where they lie, or by a broadcast of the work set once it
fits).  All steps after the first ones then read edges of work vertices only, and the
edges read in all of them are a few times the graph's.

Group columns run many graphs (e.g. periods) in the same jobs.  Up to
``MAX_GROUPS`` groups of 32-bit ids are numbered and put into one long key with the
id, so that the loops sort, hash and compare one number.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.operators.graph import PropertyGraph
from threadweave.operators.joins import GraphLayout, broadcast_ok, semi_or_anti
from threadweave.runtime import cut_observed, cut_placed, loop_conf, replace_table
from threadweave.schema import SCC_MAX_ITER, TYPE_SUBREDDIT

SHRINK = 4          # edges follow the work set when it has fallen to this part
MAX_GROUPS = 1000   # groups that are numbered into the ids


def _flag_count(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _iterate(state: DataFrame, step: Callable[[DataFrame], DataFrame], name: str, flag: Column,
             ground: Ground | None = None, **extra: Column) -> tuple[DataFrame, dict]:
    """Apply ``step`` until no row has ``flag`` set, one written state per step (a
    step reads its state twice).  The (lazy) start state is folded into the
    first written step; steps on a converged state change nothing.  ``ground``:
    edges that follow the rows of the state."""
    path = None
    while True:
        state, m = cut_placed(step(state), name, active=_flag_count(flag), **extra)
        path = replace_table(state.sparkSession, path, m["path"])
        if m["active"] == 0:
            return state, m
        if ground is not None:
            state, moved = ground.follow(state, m["rows"])
            path = path if moved is None else replace_table(state.sparkSession, path, moved)


def _restrict(edges: DataFrame, alive: DataFrame, g: list[str], n_alive: int) -> tuple[DataFrame, int]:
    """Edges with both ends among few enough vertices to be broadcast, written out."""
    e = semi_or_anti(edges, alive.withColumnRenamed("id", "src"), [*g, "src"], n_alive, "left_semi")
    e = semi_or_anti(e, alive.withColumnRenamed("id", "dst"), [*g, "dst"], n_alive, "left_semi")
    e, m = cut_observed(e, "scc-edges")
    return e, m["rows"]


class Ground:
    """The laid-out edges of a work set, which shrink with it."""

    def __init__(self, spark: SparkSession, edges: DataFrame, n_edges: int, n_work: int, g: list[str], whole: bool, confs: ExitStack):
        self.spark, self.g, self.n_work, self.whole, self.confs = spark, g, n_work, whole, confs
        collapse = (lambda df: df) if whole else (lambda df: df.dropDuplicates([*g, "src", "dst"]))
        self.layout = GraphLayout.of(edges, g, n_edges, n_work, collapse)

    def follow(self, state: DataFrame, n: int) -> tuple[DataFrame, str | None]:
        """Drop the edges of vertices without a row in ``state`` (``n`` written rows)
        if that is worth it.  The state, and its new path if it was dealt out anew."""
        keys = [*self.g, "id"]
        alive = state.select(*keys)
        small = broadcast_ok(alive, n)
        if n == 0 or SHRINK * n > self.n_work and (self.whole or not small):
            return state, None
        old, self.n_work, path = self.layout, n, None
        if small:   # broadcasts cut the edges down wherever they lie
            edges, n_edges = _restrict(old.by_src.all_edges(), alive, self.g, n)
            self.layout, self.whole = GraphLayout.of(edges, self.g, n_edges, n), True
            parts = self.confs.enter_context(loop_conf(self.spark, max(n_edges, n)))
            if state.rdd.getNumPartitions() > parts:
                state, m = cut_placed(state.repartition(parts, *keys), "scc-work")
                path = m["path"]
        else:
            self.layout, self.whole = old.among(alive), False
        old.release()
        return state, path

    def release(self) -> None:
        self.layout.release()


def _degrees(work: DataFrame, n_work: int, layout: GraphLayout, g: list[str], whole: bool) -> DataFrame:
    """(keys, indeg, outdeg) inside the work set.  ``whole``: every edge has both
    ends in it, so the edges of a key are counted where they lie."""
    keys = [*g, "id"]
    if whole:
        out = layout.by_src.count_keys("outdeg").withColumnRenamed("src", "id")
        into = layout.by_dst.count_keys("indeg").withColumnRenamed("dst", "id")
    else:
        out = (layout.by_dst.join(work.withColumnRenamed("id", "dst"), n_work)
               .groupBy(*g, F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outdeg")))
        into = (layout.by_src.join(work.withColumnRenamed("id", "src"), n_work)
                .groupBy(*g, F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("indeg")))
    return (work.join(into, keys, "left").join(out, keys, "left")
            .select(*keys, F.coalesce("indeg", F.lit(0)).alias("indeg"), F.coalesce("outdeg", F.lit(0)).alias("outdeg")))


def _trim(work: DataFrame, ground: Ground, whole: bool) -> tuple[DataFrame, int]:
    """Peel vertices without in- or out-edges until none is left; the survivors.
    ``whole``: every edge has both ends in the work set."""
    g = ground.g
    keys = [*g, "id"]
    dead = (F.col("indeg") <= 0) | (F.col("outdeg") <= 0)

    def step(d: DataFrame) -> DataFrame:
        frontier = d.filter(dead).select(*keys)
        # an edge out of a peeled vertex costs its head one in-degree, and vice versa
        lost_in = (ground.layout.by_src.join(frontier.withColumnRenamed("id", "src"), ground.n_work)
                   .groupBy(*g, F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("di")))
        lost_out = (ground.layout.by_dst.join(frontier.withColumnRenamed("id", "dst"), ground.n_work)
                    .groupBy(*g, F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("do")))
        return (d.filter(~dead).join(lost_in, keys, "left").join(lost_out, keys, "left")
                .select(*keys, (F.col("indeg") - F.coalesce("di", F.lit(0))).alias("indeg"),
                        (F.col("outdeg") - F.coalesce("do", F.lit(0))).alias("outdeg")))

    # the degree table is costly to rebuild, so it is written before the
    # peeling steps (which reference their input twice) instead of folded in
    deg, start = cut_placed(_degrees(work, ground.n_work, ground.layout, g, whole), "scc-degrees", active=_flag_count(dead))
    if not start["active"]:
        return deg.select(*keys), start["rows"]
    deg, m = _iterate(deg, step, "scc-degrees", dead, ground)
    replace_table(work.sparkSession, start["path"], m["path"])
    return deg.select(*keys), m["rows"]


def _colour(work: DataFrame, ground: Ground) -> DataFrame:
    """Minimum ancestor id per work vertex: (keys, color)."""
    g = ground.g
    keys = [*g, "id"]

    def step(state: DataFrame) -> DataFrame:
        front = state.filter("changed").select(*g, F.col("id").alias("src"), F.col("color").alias("c"))
        msgs = ground.layout.by_src.join(front, ground.n_work).groupBy(*g, F.col("dst").alias("id")).agg(F.min("c").alias("m"))
        better = F.coalesce(F.col("m") < F.col("color"), F.lit(False))
        return state.join(msgs, keys, "left").select(
            *keys, F.when(better, F.col("m")).otherwise(F.col("color")).alias("color"), better.alias("changed"))

    start = work.select(*keys, F.col("id").alias("color"), F.lit(True).alias("changed"))
    state, _ = _iterate(start, step, "scc-colour", F.col("changed"))
    return state.select(*keys, "color")


def _sweep(colours: DataFrame, ground: Ground) -> tuple[DataFrame, int]:
    """Settle vertices that reach their colour's root through same-colour vertices."""
    g = ground.g
    keys = [*g, "id"]

    def step(state: DataFrame) -> DataFrame:
        front = state.filter("fresh").select(*g, F.col("id").alias("dst"), F.col("color").alias("c"))
        # a tail's colour is at least its head's (the head has all its ancestors), so
        # of the colours it hears only the largest can be its own
        heard = ground.layout.by_dst.join(front, ground.n_work).groupBy(*g, F.col("src").alias("id")).agg(F.max("c").alias("c"))
        hit = F.coalesce(F.col("c") == F.col("color"), F.lit(False))
        return state.join(heard, keys, "left").select(
            *keys, "color", (F.col("final") | hit).alias("final"), (hit & ~F.col("final")).alias("fresh"))

    root = F.col("id") == F.col("color")
    start = colours.select(*keys, "color", root.alias("final"), root.alias("fresh"))
    state, m = _iterate(start, step, "scc-sweep", F.col("fresh"), final=_flag_count(F.col("final")))
    settled = state.filter("final").select(*keys, F.col("color").alias("component"))
    return settled, m["final"]


def group_numbers(vertices: DataFrame, g: list[str]) -> DataFrame | None:
    """(group..., _group): a number for each group of written vertices; None where ids
    or groups don't fit one long key."""
    if not g or vertices.schema["id"].dataType.typeName() not in ("integer", "short", "byte"):
        return None
    groups = vertices.select(*g).dropna().distinct().limit(MAX_GROUPS + 1).collect()
    if not 0 < len(groups) <= MAX_GROUPS:
        return None
    numbered = [F.struct(*[F.lit(v).cast(vertices.schema[c].dataType).alias(c) for c, v in zip(g, row, strict=True)],
                         F.lit(i).cast("long").alias("_group")) for i, row in enumerate(groups)]
    return vertices.sparkSession.range(1).select(F.inline(F.array(*numbered)))


def _joint(id_: str) -> Column:
    """Group number and 32-bit id as one long, in the order of the ids within a group."""
    return F.shiftleft("_group", 32) + F.col(id_).cast("long")


def _own_id(joint: Column) -> Column:
    return joint - F.shiftleft(F.shiftright(joint + F.lit(1 << 31), 32), 32)


def scc_labels(graph: PropertyGraph, max_iter: int = SCC_MAX_ITER) -> DataFrame:
    """(group..., id, component) for every distinct vertex id."""
    g = list(graph.group)
    keys = [*g, "id"]
    vertices, mv = cut_observed(graph.vertices.select(*keys).distinct(), "scc-vertices")
    pairs = graph.edges.select(*g, "src", "dst")
    numbers = group_numbers(vertices, g)
    if numbers is None:
        found = _settled(vertices, pairs, g, mv["rows"], max_iter)
        labelled = vertices if found is None else vertices.join(found, keys, "left")
    else:
        near = F.broadcast(numbers)
        found = _settled(vertices.join(near, g).select(_joint("id").alias("id")),
                         pairs.join(near, g).select(_joint("src").alias("src"), _joint("dst").alias("dst")), [], mv["rows"], max_iter)
        if found is not None:
            found = found.select(F.col("id").alias("_joint"), _own_id(F.col("component")).cast(vertices.schema["id"].dataType).alias("component"))
            labelled = vertices.join(near, g, "left").withColumn("_joint", _joint("id")).join(found, "_joint", "left")
    if found is None:
        return vertices.withColumn("component", F.col("id"))
    return labelled.select(*keys, F.coalesce(F.col("component"), F.col("id")).alias("component"))


def _settled(vertices: DataFrame, pairs: DataFrame, g: list[str], n_work: int, max_iter: int) -> DataFrame | None:
    """(group..., id, component) of the vertices that sweeps settle; None if there is none."""
    keys = [*g, "id"]
    spark = vertices.sparkSession
    whole = broadcast_ok(vertices, n_work)   # edges have both ends in the work set
    if whole:
        edges, n_edges = _restrict(pairs.distinct(), vertices, g, n_work)
    else:
        edges, me = cut_observed(pairs, "scc-edges")
        n_edges = me["rows"]

    settled: list[DataFrame] = []
    rnd, ground = 0, None
    with ExitStack() as confs:
        parts = confs.enter_context(loop_conf(spark, max(n_edges, n_work)))
        work, _ = cut_placed(vertices.repartition(parts, *keys), "scc-work")
        try:
            # The last round would only trim, and trimmed vertices keep their own
            # id exactly like unsettled ones, so it is skipped.
            while n_work > 0 and rnd + 1 < max_iter:
                rnd += 1
                if ground is None:
                    ground = Ground(spark, edges, n_edges, n_work, g, whole, confs)
                work, n_left = _trim(work, ground, whole)
                if n_left == 0:
                    break
                work, _ = ground.follow(work, n_left)
                # edges to peeled vertices stay: messages start from work vertices
                # only and change work rows only
                colours = _colour(work, ground)
                done, n_done = _sweep(colours, ground)
                settled.append(done)
                if rnd + 1 >= max_iter:
                    break
                work, mw = cut_placed(semi_or_anti(work, done.select(*keys), keys, n_done, "left_anti"), "scc-work")
                n_work = mw["rows"]
                if broadcast_ok(work, n_work) and n_work:
                    # few enough vertices: the next round's degrees are counted on their own edges
                    rest, n_edges = _restrict(ground.layout.by_src.all_edges(), work, g, n_work)
                    ground.release()
                    ground, edges, whole = None, rest, True
                else:
                    work, _ = ground.follow(work, n_work)
        finally:
            if ground is not None:
                ground.release()
    if not settled:
        return None
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    return found


def labels_with_sinks(labels: DataFrame, vertices: DataFrame) -> DataFrame:
    """Labels of a graph that has, beside the labelled graph, only vertices
    without an out-edge: each is peeled in the first trim and is its own
    component, and what remains is the labelled graph, whatever the round limit.

    ``labels``: (id, component); ``vertices``: all ids, with their attributes."""
    return (vertices.join(labels, "id", "left")
            .withColumn("component", F.coalesce(F.col("component"), F.col("id"))))


def property_labels(labels: DataFrame, graph: PropertyGraph, max_iter: int = SCC_MAX_ITER) -> DataFrame:
    """Vertex rows of a property graph plus ``component``, from the written labels
    of its user graph: its subreddits have no out-edge.  Where a subreddit's id is
    also a user's, the two are one vertex, and the graph is labelled by itself."""
    subs = graph.vertices.filter(F.col("type") == TYPE_SUBREDDIT).select("id")
    if labels.join(subs, "id", "left_semi").limit(1).count():
        return strongly_connected_components(graph, max_iter)
    return labels_with_sinks(labels, graph.vertices)


def strongly_connected_components(graph: PropertyGraph, max_iter: int = SCC_MAX_ITER) -> DataFrame:
    """Vertex rows (with their attributes) plus ``component``."""
    return graph.vertices.join(scc_labels(graph, max_iter), graph.keys)
