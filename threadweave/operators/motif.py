"""Collaboration motif across two subreddits.

Pattern (bag semantics, one row per choice of edges):
``(u)-[e1]->(s); (u)-[e2]->(s2); (u2)-[e3]->(s); (u2)-[e4]->(s2);
(u2)-[e5]->(u); (u)-[e6]->(u2)`` with s, s2 of type subreddit, s != s2,
u != u2 and e5, e6 ``commented``: two users who both post in two subreddits
and comment on each other.  Output ``user1, subreddit1, subreddit2, user2``.

A match's multiplicity is the product of the six parallel-edge counts, and
the pattern is symmetric under u<->u2 and s<->s2.  Plan (never joins the members of a subreddit with each other — that is the
blow-up):

1. collapse edges to counts: commented (src, dst, n) and into-subreddit
   (user, sub, n), each written once;
2. mutual commenting pairs u < u2 (the selective part) — one self-join of the
   collapsed commented edges;
3. subreddits both users post in: pair ⋈ posts(u) on u, then ⋈ posts(u2) on
   the composite (u2, s) key, so a hot subreddit is never a join key; written
   once, with the subreddit's name;
4. one list of shared subreddits per pair, with the users' names.  Pairs of
   shared subreddits s < s2 (these ARE the results) are expanded from the list
   where it lies: each element with the part of the list after it;
5. the four mirror images, where each result is made.

A list is no longer than the subreddits of a user, and its pairs are results, so
nothing is made that is not returned.

Counts are longs; a multiplicity is a decimal, as the product of six counts
outgrows 64 bits for busy users (below that it is computed as a long).  The bag form repeats a row block by block: a first step makes one
row per block of ``BLOCK`` copies (and per ``BLOCK`` such rows, and so on),
those are dealt out evenly, and each then makes its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadweave.operators.graph import PropertyGraph
from threadweave.operators.joins import broadcast_ok, semi_or_anti
from threadweave.runtime import cut, cut_observed
from threadweave.schema import REL_COMMENTED, REL_POSTED, TYPE_SUBREDDIT

BLOCK = 10_000  # copies that one row makes at once
COUNT = "decimal(38,0)"
LONG_SAFE = 9.0e18  # a product estimated below this fits a long


def shared_subreddits(graph: PropertyGraph, posted_only: bool = False) -> DataFrame:
    """(u, u2, s, ns, a, k), u < u2: the subreddits (with their names) that both
    users of a mutually commenting pair post in.  ``a``: choices of the two edges
    into it, ``k``: of the two between the users.

    ``posted_only``: the alternate predicates - the edges into subreddits are
    ``posted`` ones, and the edges between the users of any relationship."""
    e = graph.edges
    subs, ms = cut_observed(graph.vertices.filter(F.col("type") == TYPE_SUBREDDIT).select("id", "name").distinct(), "motif-subreddits")
    into = e.filter(F.col("relationship") == REL_POSTED) if posted_only else e
    between = e if posted_only else e.filter(F.col("relationship") == REL_COMMENTED)
    into_sub = semi_or_anti(into, subs.select(F.col("id").alias("dst")).distinct(), ["dst"], ms["rows"], "left_semi")
    posts = cut(into_sub.groupBy(F.col("src").alias("u"), F.col("dst").alias("s"))
                .agg(F.count(F.lit(1)).alias("n")), "motif-posts")
    comm = cut(between.filter(F.col("src") != F.col("dst")).groupBy("src", "dst")
               .agg(F.count(F.lit(1)).alias("n")), "motif-comments")

    fwd = comm.filter(F.col("src") < F.col("dst")).select(
        F.col("src").alias("u"), F.col("dst").alias("u2"), F.col("n").alias("n6"))
    back = comm.filter(F.col("src") > F.col("dst")).select(
        F.col("dst").alias("u"), F.col("src").alias("u2"), F.col("n").alias("n5"))
    mutual = fwd.join(back, ["u", "u2"])
    p_u = posts.select("u", "s", F.col("n").alias("n1"))
    p_u2 = posts.select(F.col("u").alias("u2"), "s", F.col("n").alias("n3"))
    names = subs.select(F.col("id").alias("s"), F.col("name").alias("ns"))
    names = F.broadcast(names) if broadcast_ok(names, ms["rows"]) else names
    both = mutual.join(p_u, "u").join(p_u2, ["u2", "s"]).join(names, "s")
    return cut(both.select("u", "u2", "s", "ns", _times("n1", "n3").alias("a"), _times("n5", "n6").alias("k")), "motif-shared")


def _times(*cols: str | Column) -> Column:
    """Exact product as a decimal; as a long while it surely fits one."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    about, exact, short = (c.cast(t) for c, t in zip([cols[0]] * 3, ("double", COUNT, "long"), strict=True))
    for c in cols[1:]:
        about, exact, short = about * c.cast("double"), (exact * c.cast(COUNT)).cast(COUNT), short * c.cast("long")
    return F.when(about < LONG_SAFE, short.cast(COUNT)).otherwise(exact)


def motif_named(graph: PropertyGraph, posted_only: bool = False) -> DataFrame:
    """(user1, subreddit1, subreddit2, user2, matches), one row per distinct id
    quadruple; all four mirror images."""
    shared = shared_subreddits(graph, posted_only)
    lists = (shared.groupBy("u", "u2", "k").agg(F.sort_array(F.collect_list(F.struct("s", "ns", "a"))).alias("l"))
             .filter(F.size("l") > 1))
    v = graph.vertices
    named = (lists.join(v.select(F.col("id").alias("u"), F.col("name").alias("nu")), "u")
             .join(v.select(F.col("id").alias("u2"), F.col("name").alias("nu2")), "u2"))
    # each element of the list, then those after it; an id with several names has an element for each
    one = named.select("nu", "nu2", "k", "l", F.posexplode("l").alias("p", "x"))
    two = (one.select("nu", "nu2", "k", "x", F.explode(F.expr("slice(l, p + 2, size(l) - p - 1)")).alias("y"))
           .filter(F.col("x.s") < F.col("y.s")))
    image = lambda a, x, y, b: F.struct(F.col(a).alias("user1"), F.col(x).alias("subreddit1"),
                                        F.col(y).alias("subreddit2"), F.col(b).alias("user2"))
    mirrors = F.explode(F.array(image("nu", "x.ns", "y.ns", "nu2"), image("nu", "y.ns", "x.ns", "nu2"),
                                image("nu2", "x.ns", "y.ns", "nu"), image("nu2", "y.ns", "x.ns", "nu"))).alias("m")
    return two.select(mirrors, _times(F.col("x.a"), F.col("y.a"), F.col("k")).alias("matches")).select("m.*", "matches")


def motif_distinct(graph: PropertyGraph, posted_only: bool = False) -> DataFrame:
    """Distinct name quadruples with the number of raw matches behind each."""
    return (motif_named(graph, posted_only).groupBy("user1", "subreddit1", "subreddit2", "user2")
            .agg(F.sum("matches").cast(COUNT).alias("matches")))


def repeat_rows(df: DataFrame, times: str, block: int = BLOCK) -> DataFrame:
    """Each row as often as its ``times`` column says, without that column.

    Rows above one block are first split into rows of at most ``block`` blocks
    each, level by level, and dealt out anew after each level, so neither a
    row nor a task ever makes more than ``block`` copies of one row at once.
    Levels are added until no row is above a block (a bounded aggregate)."""
    while True:
        most = df.agg(F.max(times)).first()[0]
        if most is None or most <= block:
            break
        # one row -> at most ``block`` rows; their shares differ by one at most
        n = F.least(F.ceil(F.col(times) / F.lit(block)), F.lit(block)).cast("long")
        share = F.floor(F.col(times) / n).cast(COUNT)
        extra = (F.col(times) - share * n).cast("long")
        df = cut(df.withColumn("_n", n).withColumn("_share", share).withColumn("_extra", extra)
                 .withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
                 .withColumn(times, (F.col("_share") + F.when(F.col("_k") <= F.col("_extra"), 1).otherwise(0)).cast(COUNT))
                 .drop("_n", "_share", "_extra", "_k"), "repeat-rows")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times).cast("long"))).alias("_k")
    return df.hint("rebalance").select(*[c for c in df.columns if c != times], copies).drop("_k")


def motif_raw(graph: PropertyGraph, posted_only: bool = False) -> DataFrame:
    """Bag form: each quadruple repeated by its multiplicity."""
    return repeat_rows(cut(motif_named(graph, posted_only), "motif-named"), "matches")
