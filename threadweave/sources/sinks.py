"""Sinks: parquet stages, header-less CSV, JSON lines, pair text.

Default save mode is ``errorifexists`` (never overwrite a result silently).
``single_file=True`` leaves one part file: the tasks write their parts in
parallel as ever (sorted output: in range order), and the parts are then joined
end to end through the Hadoop file system, in their order - by name only where
the file system can concatenate, otherwise streamed in blocks.  No task reads
all rows, and the order of the rows is kept.

``write_bucketed`` stores a stage by the key that the next step joins on;
``read_stage`` reads it (or any other stage) back, and a join or an aggregation
on that key then needs no exchange.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.schema import MONTH_COL

COPY_BUFFER = 4 << 20
LAYOUT = "_layout.json"   # hidden from Spark's readers


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def part_number(name: str) -> int:
    return int(name.split("-")[1])


def merge_parts(spark: SparkSession, folder: str) -> str | None:
    """Join the part files of a written folder into its first, in their order;
    the merged file's path (None if the folder has no parts)."""
    fs, base = _hadoop(spark, folder)
    names = sorted((s.getPath().getName() for s in fs.listStatus(base) if s.getPath().getName().startswith("part-")), key=part_number)
    if not names:
        return None
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(base, name)
    first, rest = path(names[0]), [path(n) for n in names[1:]]
    if rest and fs.hasPathCapability(first, "fs.capability.paths.concat"):
        sources = spark._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
        for i, p in enumerate(rest):
            sources[i] = p
        fs.concat(first, sources)
    elif rest:
        merged = path("_merging")
        out = fs.create(merged, True)
        try:
            for p in (first, *rest):
                part = fs.open(p)
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, COPY_BUFFER, False)
                finally:
                    part.close()
        finally:
            out.close()
        # the parts stay until the merged file is whole
        for p in (first, *rest):
            fs.delete(p, False)
        fs.rename(merged, first)
    return first.toString()


def _finish(df: DataFrame, path: str, single_file: bool) -> str:
    if single_file:
        merge_parts(df.sparkSession, path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by_month: bool = False) -> str:
    w = df.write.mode(mode)
    if partition_by_month and MONTH_COL in df.columns:
        w = w.partitionBy(MONTH_COL)
    w.parquet(path)
    return path


def write_bucketed(df: DataFrame, path: str, by: Sequence[str], buckets: int) -> str:
    """A parquet stage in ``buckets`` files, by the hash of ``by`` and sorted by it.

    The files carry the layout, a small file beside them names it, so the stage
    can be read by another session."""
    spark, name, by = df.sparkSession, f"stage_{uuid.uuid4().hex[:12]}", list(by)
    (df.repartition(buckets, *by).sortWithinPartitions(*by).write.mode("errorifexists").format("parquet")
     .bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")   # the files stay: the table is external
    fs, target = _hadoop(spark, f"{path.rstrip('/')}/{LAYOUT}")
    out = fs.create(target, True)
    out.write(bytearray(json.dumps({"by": by, "buckets": buckets}).encode()))
    out.close()
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A written stage; with its buckets if it has any."""
    fs, target = _hadoop(spark, f"{path.rstrip('/')}/{LAYOUT}")
    plain = spark.read.parquet(path)
    if not fs.exists(target):
        return plain
    layout = _read_json(spark, fs, target)
    name, by = f"stage_{uuid.uuid4().hex[:12]}", ", ".join(f"`{c}`" for c in layout["by"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    stage = spark.table(name)
    stage.schema   # resolved: the plan knows the files and their buckets without the catalog
    spark.sql(f"DROP TABLE {name}")
    return stage


def _read_json(spark: SparkSession, fs, target) -> dict:
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> str:
    # Array columns are not CSV-writable; join them as text.
    cols = [F.array_join(F.col(f.name), ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode(mode).option("header", "false").csv(path)
    return _finish(df, path, single_file)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> str:
    df.write.mode(mode).json(path)
    return _finish(df, path, single_file)


def pair_lines(df: DataFrame, key_col: str = "pair", count_col: str = "count") -> DataFrame:
    """``(key,count)`` text lines, the rendering of a (String, Int) tuple."""
    return df.select(F.format_string("(%s,%d)", F.col(key_col), F.col(count_col)).alias("value"))


def write_pair_text(df: DataFrame, path: str, key_col: str = "pair", count_col: str = "count",
                    mode: str = "errorifexists", single_file: bool = False) -> str:
    pair_lines(df, key_col, count_col).write.mode(mode).text(path)
    return _finish(df, path, single_file)
