"""Written intermediate tables and size-checked broadcasts for the operators
that need more than one pass."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadweave.llm.shipping import ship
from threadweave.runtime import scratch_path

#: A key set or narrow lookup table is broadcast up to this many rows (a few
#: tens of MB); beyond, the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000


class Workspace:
    """Parquet tables in the shared checkpoint folder, one folder per use.

    A written table cuts lineage and outlives lost executors.  ``drop`` removes
    a table that later steps no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark, self.root = spark, scratch_path(spark, name)
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The table read back, and its counted rows (counted in the same job)."""
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        path = self.paths[name] = f"{self.root}/{name}-{len(self.paths)}"
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get["rows"]

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(hadoop).delete(path, True)

    def settle(self) -> None:
        """Let Spark's cleaner remove the shuffles of steps whose tables are written:
        the driver's references go first, then the cleaner sees what is left."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def without_rows(docs: DataFrame, judged: DataFrame, mark: Column, work: Workspace) -> DataFrame:
    """The rows of ``docs``, all columns, that were not judged to go.

    ``judged``: (doc_id, mark, kept) of every row, where rows with the same mark
    (``mark`` computes it from ``text``) and ``doc_id`` are judged alike.  An id
    that has no kept row goes by the id alone; only the rows of an id with both
    kinds are told apart by their marks.  Rows with a null ``doc_id`` stay."""
    gone, n_gone = work.write(judged.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id", "mark").distinct(), "gone")
    stay = judged.filter("kept").select("doc_id")
    both, n_both = work.write(gone.select("doc_id").distinct().join(stay, "doc_id", "left_semi"), "both")
    name, key = free_name(docs, "gone_id"), F.col("doc_id").cast("long")

    def named(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("doc_id", name)

    def drop(rows: DataFrame, ids: DataFrame, n: int) -> DataFrame:
        return rows.join(small(named(ids), n), key == F.col(name), "left_anti")

    if not n_both:
        return drop(docs, gone.select("doc_id"), n_gone)
    sure = gone.join(small(both, n_both), "doc_id", "left_anti").select("doc_id")
    apart = drop(drop(docs, sure, n_gone), both, n_both)
    mixed = docs.join(small(named(both), n_both), key == F.col(name), "left_semi")
    marks = named(gone.join(small(both, n_both), "doc_id", "left_semi"))
    text = free_name(docs, "gone_mark")
    mixed = mixed.join(small(marks.withColumnRenamed("mark", text), n_gone), (key == F.col(name)) & (mark == F.col(text)), "left_anti")
    return apart.unionByName(mixed)
