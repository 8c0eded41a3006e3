import os

import pytest
from pyspark.sql.utils import AnalysisException

from threadweave.runtime import scratch_path
from threadweave.sources import sinks


def test_sinks_roundtrip(spark):
    df = spark.createDataFrame([("a,b", 3), ("c,d", 1)], "pair string, count bigint")
    path = sinks.write_pair_text(df, scratch_path(spark, "t-text"), single_file=True)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["(a,b,3)", "(c,d,1)"]
    assert len([f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]) == 1
    with pytest.raises(AnalysisException):
        sinks.write_pair_text(df, path)          # errorifexists
    arr = spark.createDataFrame([(1, ["x", "y"])], "component int, names array<string>")
    p2 = sinks.write_csv(arr, scratch_path(spark, "t-csv"))
    assert spark.read.csv(p2).collect()[0][1] == "x,y"


@pytest.mark.parametrize("write, suffix", [(sinks.write_csv, "csv"), (sinks.write_json, "json")])
def test_single_file_keeps_the_order_and_the_tasks(spark, write, suffix):
    from pyspark.sql import functions as F
    df = spark.range(5000).select(F.col("id").alias("n"), F.xxhash64("id").alias("h")).orderBy("h")
    seen = []
    merge = sinks.merge_parts

    def spy(session, folder):
        seen.append(len([f for f in os.listdir(folder.removeprefix("file:")) if f.startswith("part-")]))
        return merge(session, folder)
    path = scratch_path(spark, "t-merged")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # eight ranges stay eight tasks
    sinks.merge_parts = spy
    try:
        write(df, path, single_file=True)
    finally:
        sinks.merge_parts = merge
        spark.conf.set("spark.sql.adaptive.enabled", old)
    folder = path.removeprefix("file:")
    parts = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert seen == [8] and len(parts) == 1 and parts[0].endswith(suffix)
    with open(f"{folder}/{parts[0]}") as f:
        lines = f.read().splitlines()
    hashes = [int(x.split(",")[1]) if suffix == "csv" else int(x.split(":")[2].rstrip("}")) for x in lines]
    assert len(lines) == 5000 and hashes == sorted(hashes)
    back = spark.read.schema("n long, h long")
    assert (back.csv(path) if suffix == "csv" else back.json(path)).exceptAll(df).count() == 0


def test_part_numbers_beyond_five_digits():
    names = ["part-100000-x.csv", "part-99999-x.csv", "part-00002-x.csv"]
    assert sorted(names, key=sinks.part_number) == names[::-1]


def test_bucketed_stage_needs_no_exchange(spark):
    from pyspark.sql import functions as F
    from threadweave.operators import counts, pagerank
    from threadweave.operators.graph import PropertyGraph
    path = scratch_path(spark, "t-bucketed")
    edges = spark.range(3000).select((F.col("id") % 101).cast("int").alias("src"), (F.col("id") % 7).cast("int").alias("dst"))
    sinks.write_bucketed(edges, path, ["src"], 6)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 6
    stage = sinks.read_stage(spark, path)
    assert stage.exceptAll(edges).count() == 0 and edges.exceptAll(stage).count() == 0
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = PropertyGraph(spark.range(101).withColumnRenamed("id", "id"), stage)
        for df in (pagerank.edge_weights(g), counts.pair_counts(g.edges)):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        plain = PropertyGraph(g.vertices, spark.read.parquet(path))
        assert "Exchange" in pagerank.edge_weights(plain)._jdf.queryExecution().executedPlan().toString()
        assert pagerank.edge_weights(g).exceptAll(pagerank.edge_weights(plain)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stage_")]


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["dst", "src", "count", "src_name", "src_type", "dst_name", "dst_type"]
    assert df.count() == 523
    from threadweave.plans.catalog import QUERIES
    assert set(QUERIES) <= set(entry.oracle_sql())
