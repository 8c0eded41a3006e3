"""Spark result == DuckDB oracle for catalog keys on the smallest fixture."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import digest, duck

KEYS = ["load_months", "remove_deleted_authors", "filter_subreddits", "trim_submissions", "trim_comments",
        "java_string_hash", "property_graph_vertices", "property_graph_edges", "season_union",
        "popular_posters_named", "most_common_dst", "author_subreddit_counts", "pair_counts_text",
        "pagerank_users_named", "scc_users", "scc_monthly", "scc_component_members", "top_components",
        "motif_collab", "triangles_named", "csv_export", "text_export"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as entry
    df = entry.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows) == digest(rel.columns, d_rows)
