"""What queries write: only columns that are read, and nothing after ``drop_scratch``."""

import glob
import os

import pytest

from threadweave import runtime
from threadweave.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def written(spark):
    base = runtime.checkpoint_dir(spark).removeprefix("file:")
    return {p: set(spark.read.parquet(p).columns) for p in glob.glob(f"{base}/tables/*") if os.path.isdir(p) and glob.glob(f"{p}/*.parquet")}


@pytest.mark.parametrize("key, tables", [
    ("popular_pairs_named", [{"link_hash", "op_id"}, {"link_hash", "auth_id"}, {"id", "name", "type"}]),
    ("pair_counts_text", []),
    ("most_common_subreddit", [{"id", "name", "type"}]),
    ("triangle_count", [{"link_hash", "op_id"}, {"link_hash", "auth_id"}, {"a", "b"}, {"u", "v", "dv"}, {"id", "count"}]),
])
def test_only_needed_columns_are_written(spark, key, tables):
    runtime.drop_scratch(spark)
    before = set(written(spark))
    QUERIES[key](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    new = [c for p, c in written(spark).items() if p not in before]
    assert sorted(map(sorted, new)) == sorted(map(sorted, tables))
    runtime.drop_scratch(spark)
    assert not set(written(spark)) - before


def test_loops_delete_superseded_states(spark):
    runtime.drop_scratch(spark)
    QUERIES["scc_monthly"](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    base = runtime.checkpoint_dir(spark).removeprefix("file:")
    # the vertices, and the last degrees, colours and sweep of the one round
    assert len(glob.glob(f"{base}/rdd-*")) <= 4
    runtime.drop_scratch(spark)
    assert not glob.glob(f"{base}/rdd-*")
