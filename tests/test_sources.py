from pyspark.sql import functions as F

from threadweave.runtime import scratch_path
from threadweave.sources import fixture, sinks
from threadweave.sources.monthly import read_month_folders, read_prepped, write_month_folders
from threadweave.operators import prep
from tests.conftest import SF_SMALL


def test_month_folders_roundtrip_with_drift(spark):
    raw = fixture.submissions_raw(spark, SF_SMALL)
    base = scratch_path(spark, "months")
    months = ["1996-06", "1996-07", "1996-08"]
    for i, m in enumerate(months):
        part = raw.filter(F.col("month") == m).drop("month")
        if i == 1:   # a month with an extra column and another column order
            part = part.withColumn("upvotes", F.lit(1)).select("upvotes", *reversed(part.columns))
        part.write.parquet(f"{base}/RS-{m}")
    got = read_month_folders(spark, base, "RS", ",".join(months))
    want = raw.filter(F.col("month").isin(months))
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    assert got.filter(F.col("upvotes").isNotNull()).count() == raw.filter(F.col("month") == months[1]).count()


def test_month_filter_reads_only_that_folder(spark):
    raw = fixture.submissions_raw(spark, SF_SMALL)
    base, months = scratch_path(spark, "months"), ["1996-06", "1996-07", "1996-08"]
    write_month_folders(raw, base, "RS", months)
    one = read_month_folders(spark, base, "RS", months).filter(F.col("month") == "1996-07")
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert {"RS-1996-07" in f for f in one.inputFiles()} == {True}
    assert one.count() == raw.filter(F.col("month") == "1996-07").count()


def test_prepped_partitioned_by_month(spark):
    c = prep.prep_comments(fixture.comments_raw(spark, SF_SMALL))
    path = sinks.write_parquet(c, scratch_path(spark, "prepped"), partition_by_month=True)
    sub = read_prepped(spark, path, ["1996-06"])
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1996-06" in plan
    assert sub.count() == c.filter(F.col("month") == "1996-06").count()


def test_json_with_array_column(spark):
    df = spark.createDataFrame([(7, 3, ["a", "b", "c"], "a", "user")],
                               "component int, count bigint, names array<string>, name string, type string")
    path = sinks.write_json(df, scratch_path(spark, "json"))
    back = spark.read.schema(df.schema).json(path).collect()[0]
    assert back.names == ["a", "b", "c"]
