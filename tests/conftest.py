import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from threadweave.runtime import local_session
    s = local_session(cores=8, shuffle_partitions=8, app="threadweave-tests")
    yield s
    s.stop()


@pytest.fixture
def hand_graph(spark):
    """Parallel edge, self-loop, reciprocal pair, sink, triangle."""
    from threadweave.operators.graph import PropertyGraph
    edges = spark.createDataFrame(
        [(1, 2), (1, 2), (2, 1), (2, 3), (3, 3), (4, 5), (5, 6), (6, 4), (6, 7), (4, 6)], "src int, dst int")
    vertices = spark.createDataFrame([(i,) for i in range(1, 8)], "id int")
    return PropertyGraph(vertices, edges)


@pytest.fixture
def force_split(spark):
    """Force the no-broadcast / hot-key-split join plans (what a big graph gets)."""
    from threadweave import runtime as rt
    keys = {rt.CONF_BROADCAST_ROWS: "0", rt.CONF_HOT_MIN_ROWS: "2", rt.CONF_HOT_MAX_KEYS: "3"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
