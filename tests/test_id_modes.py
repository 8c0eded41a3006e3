"""The collision-free name ids give the same graph as the hash ids (no collisions in the fixtures)."""

import pytest
from pyspark.sql import functions as F

from threadweave.operators import counts, motif, scc
from threadweave.plans import reports
from threadweave.plans.catalog import Pipeline
from tests.conftest import SF_SMALL


def test_name_ids_same_results(spark):
    h = Pipeline(spark, SF_SMALL, "hash")
    n = Pipeline(spark, SF_SMALL, "name")
    assert dict(n.user_graph.edges.dtypes)["src"] == "string"
    key = ["src_name", "dst_name", "count"]
    ph = reports.popular_pairs_named(h.pairs, h.names).select(*key)
    pn = reports.popular_pairs_named(n.pairs, n.names).select(*key)
    assert ph.count() == pn.count() and ph.exceptAll(pn).count() == 0
    md = ["user1", "subreddit1", "subreddit2", "user2", "matches"]
    assert motif.motif_distinct(h.property_graph).select(*md).exceptAll(
        motif.motif_distinct(n.property_graph).select(*md)).count() == 0

    def partition(p):   # converged SCC: the same vertex sets, whatever the labels
        lab = scc.scc_labels(p.user_graph, 10).join(p.names.select("id", "name"), "id")
        sets = lab.groupBy("component").agg(F.array_join(F.sort_array(F.collect_list("name")), ",").alias("m"))
        return sorted(r.m for r in sets.collect())

    assert partition(h) == partition(n)


@pytest.mark.parametrize("id_mode", ["hash", "name"])
def test_names_written_with_the_keys_need_no_second_join(spark, id_mode):
    plain, named = Pipeline(spark, SF_SMALL, id_mode), Pipeline(spark, SF_SMALL, id_mode, named=True)
    assert not any("lineitem" in f or "orders" in f for f in named.vertices.inputFiles())
    assert sorted(named.names.collect()) == sorted(plain.names.collect())
    assert named.post_keys.columns == ["link_hash", "op_id", "author", "subreddit"]
    assert named.comment_keys.columns == ["link_hash", "auth_id", "author"]
