"""The five steps over month folders give what the registered queries give."""

import pytest
from pyspark.sql import functions as F

from threadweave import runtime, steps
from threadweave.plans.catalog import QUERIES
from threadweave.sources import fixture
from threadweave.sources.monthly import write_month_folders
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def folders(spark):
    base = runtime.scratch_path(spark, "steps")
    posts, comments = fixture.submissions_raw(spark, SF_SMALL), fixture.comments_raw(spark, SF_SMALL)
    # by year: the fixture has too many months for one test
    posts, comments = (df.withColumn("month", F.substring("month", 1, 4)) for df in (posts, comments))
    months = sorted(r.month for r in posts.select("month").distinct().collect())
    write_month_folders(posts, f"{base}/raw", "RS_2016", months)
    write_month_folders(comments, f"{base}/raw", "RC_2016", months)
    steps.prep_step(spark, f"{base}/raw", f"{base}/raw", ",".join(months), f"{base}/prep", allow=None)
    steps.graph_step(spark, f"{base}/prep", f"{base}/graphs")
    steps.algorithm_step(spark, f"{base}/graphs", f"{base}/results")
    steps.report_step(spark, f"{base}/graphs", f"{base}/results", f"{base}/reports", f"{base}/prep", fixture.FIXTURE_AUTHORS)
    steps.motif_step(spark, f"{base}/graphs", f"{base}/reports")
    return base, months


def same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_steps_equal_the_queries(spark, folders):
    base, _ = folders
    assert same(QUERIES["comment_post_edges"](spark, SF_SMALL), spark.read.parquet(f"{base}/graphs/userEdges"))
    assert same(QUERIES["property_graph_vertices"](spark, SF_SMALL), spark.read.parquet(f"{base}/graphs/propertyVertices"))
    assert same(QUERIES["scc_users"](spark, SF_SMALL), spark.read.parquet(f"{base}/results/userComponents"))
    assert same(QUERIES["triangle_count"](spark, SF_SMALL), spark.read.parquet(f"{base}/results/triangles"))
    ranks = spark.read.parquet(f"{base}/results/userPageRankVertices").withColumn("pagerank", F.round("pagerank", 6))
    assert same(QUERIES["pagerank_users"](spark, SF_SMALL), ranks)
    popular = QUERIES["popular_pairs_named"](spark, SF_SMALL)
    assert same(popular, spark.read.schema(popular.schema).csv(f"{base}/reports/popularPairs"))
    motif = QUERIES["motif_collab"](spark, SF_SMALL)
    assert same(motif, spark.read.schema(motif.schema).json(f"{base}/reports/collabMotif"))
    property_ranks = spark.read.schema("id int, name string, type string, pagerank double").csv(f"{base}/reports/propertyPageRank")
    assert same(QUERIES["pagerank_property_graph"](spark, SF_SMALL), property_ranks.withColumn("pagerank", F.round("pagerank", 6)))
    chosen = QUERIES["author_subreddit_counts"](spark, SF_SMALL)
    assert same(chosen, spark.read.schema(chosen.schema).csv(f"{base}/reports/authorSubreddits"))
    assert same(QUERIES["scc_property_graph"](spark, SF_SMALL).select("id", "component"), spark.read.parquet(f"{base}/results/propertyComponents"))
    members = QUERIES["scc_component_members"](spark, SF_SMALL).filter("graph = 'users'").drop("graph")
    assert same(members, spark.read.schema(members.schema).json(f"{base}/reports/userComponentMembers"))


def test_prep_step_allow_list_and_months(spark, folders):
    base, months = folders
    out = runtime.scratch_path(spark, "steps-allowed")
    steps.prep_step(spark, f"{base}/raw", f"{base}/raw", months[:2], out, allow=fixture.FIXTURE_ALLOW_LIST)
    posts = spark.read.parquet(f"{out}/submissionPreppedDf")
    assert {r.subreddit for r in posts.select("subreddit").distinct().collect()} <= set(fixture.FIXTURE_ALLOW_LIST)
    assert {r.month for r in posts.select(F.col("month").cast("string").alias("month")).distinct().collect()} == set(months[:2])
    assert not {"score", "domain"} & set(posts.columns)


def test_season_step(spark, folders):
    base, months = folders
    out = runtime.scratch_path(spark, "steps-season")
    steps.season_step(spark, f"{base}/raw", f"{base}/raw", months[:3], out, allow=None)
    labels = spark.read.parquet(f"{out}/components")
    assert {r.period for r in labels.select("period").distinct().collect()} == {*months[:3], "season"}
    ids = spark.read.parquet(f"{out}/vertices").filter("period = 'season'").count()
    assert ids == spark.read.parquet(f"{out}/pageRankVertices").count() == spark.read.parquet(f"{out}/triangles").count()
    months = {*months[:3]}
    top = spark.read.parquet(f"{out}/topComponents")
    assert {r.period for r in top.select("period").distinct().collect()} == {*months, "season"}
    sizes = labels.groupBy("period", "component").agg(F.count(F.lit(1)).alias("count"))
    assert top.drop("rank").exceptAll(sizes.select("period", "component", "count")).count() == 0
    best = {r.period: r.component for r in top.filter("rank = 1").collect()}
    authors = spark.read.parquet(f"{out}/commentsOfTopAuthor").select("period", "auth_id").distinct().collect()
    assert all(best[r.period] == r.auth_id for r in authors) and "season" not in {r.period for r in authors}
    lines = [r.value for r in spark.read.text(f"{out}/pairCounts").collect()]
    edges = spark.read.parquet(f"{out}/edges").filter("period = 'season'").count()
    assert lines and sum(int(x.rstrip(")").rsplit(",", 1)[1]) for x in lines) >= edges
    assert spark.read.csv(f"{out}/topPageRank").count() > 0


def test_season_query_reads_the_folders(spark, monkeypatch):
    """Equal to the date-range query, and different as soon as a month folder is skipped."""
    from threadweave.plans import catalog
    want = QUERIES["scc_monthly"](spark, SF_SMALL)
    assert same(want, QUERIES["season_from_folders"](spark, SF_SMALL))
    read = steps.read_month_folders
    monkeypatch.setattr(steps, "read_month_folders", lambda s, folder, prefix, months: read(s, folder, prefix, months[1:]))
    assert not same(want, catalog.q_season_from_folders(spark, SF_SMALL))


def test_stage_write_deals_rows_to_more_tasks_as_they_grow(spark, monkeypatch):
    """The task that sorts its rows by month gets a layout's rows at most."""
    from threadweave.plans import catalog
    seen, write = [], catalog.sinks.write_parquet

    def spy(df, *args, **kw):
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return write(df, *args, **kw)
    monkeypatch.setattr(catalog.sinks, "write_parquet", spy)
    spark.conf.set("threadweave.iter.rowsPerPartition", "300")
    try:
        n = QUERIES["stage_roundtrip"](spark, SF_SMALL).count()
    finally:
        spark.conf.unset("threadweave.iter.rowsPerPartition")
    assert seen[0] >= n / 300 > 8 and spark.conf.get("spark.sql.shuffle.partitions") == "8"
