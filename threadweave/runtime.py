"""Session helpers: checkpoint location, scratch tables and tuning knobs.

Library code never invents a machine-local folder on a cluster: iterative
operators cut lineage with ``DataFrame.checkpoint`` into the shared folder the
session names in ``spark.checkpoint.dir``.  Only a local-mode session (tests,
bench) without that setting gets a fresh folder under /tmp.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Knobs (session conf keys) with their defaults.  They bound what may be
# broadcast and decide which keys count as "hot" for the skew-split joins.
CONF_BROADCAST_ROWS = "threadweave.broadcast.maxRows"      # narrow (id + a few numbers) tables
CONF_BROADCAST_BYTES = "threadweave.broadcast.maxBytes"    # tables that a shuffle join can replace; default: by the driver's heap
CONF_HOT_MAX_KEYS = "threadweave.skew.maxHotKeys"          # bound on the broadcast hot-key set
CONF_HOT_MIN_ROWS = "threadweave.skew.minHotRows"          # a key is hot above this many rows
CONF_CHECKPOINT_EVERY = "threadweave.iter.checkpointEvery"  # iterations between checkpoints
CONF_LOOP_ADAPTIVE = "threadweave.iter.adaptive"           # AQE inside iteration loops
CONF_LAYOUT_ROWS = "threadweave.iter.rowsPerPartition"     # rows per partition of an edge layout

DEFAULTS = {
    CONF_BROADCAST_ROWS: 2_000_000,
    CONF_HOT_MAX_KEYS: 100_000,
    CONF_HOT_MIN_ROWS: 200_000,
    CONF_CHECKPOINT_EVERY: 5,
    CONF_LOOP_ADAPTIVE: False,
    CONF_LAYOUT_ROWS: 2_000_000,
}


#: A broadcast table is in the driver several times at once: as collected rows, as a
#: hash table with the half that it grew from, as the blocks sent, and in network buffers.
HEAP_PER_BROADCAST = 32

COALESCED = "32m"   # shuffled bytes of a task whose rows are wide where they are written


def conf_int(spark: SparkSession, key: str) -> int:
    return int(spark.conf.get(key, str(DEFAULTS[key])))


def broadcast_bytes(spark: SparkSession) -> int:
    """Bytes of a table that the driver may build for a join that could also shuffle."""
    configured = spark.conf.get(CONF_BROADCAST_BYTES, None)
    if configured is not None:
        return int(configured)
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // HEAP_PER_BROADCAST


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared (HDFS/object store) folder; "
                           "iterative graph operators checkpoint there")
    folder = tempfile.mkdtemp(prefix="threadweave-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def _scratch_list(spark: SparkSession) -> list[str]:
    """Scratch folders handed out in this Spark application."""
    sc = spark.sparkContext
    if not hasattr(sc, "_threadweave_scratch"):
        sc._threadweave_scratch = []
    return sc._threadweave_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, next to the checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    _scratch_list(spark).append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> int:
    """Delete every scratch table of this application; for use between queries,
    once their results are consumed (a lazy result reads its tables).  Returns
    how many folders were dropped."""
    paths = _scratch_list(spark)
    for path in paths:
        delete_path(spark, path)
    n = len(paths)
    paths.clear()
    return n


def _forget(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that no later step reads."""
    delete_path(spark, path)
    if path in _scratch_list(spark):
        _scratch_list(spark).remove(path)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage: write the frame as a parquet table in the shared checkpoint
    folder and read it back.

    One job (an eager ``checkpoint()`` computes its plan twice unless cached),
    the table survives executor loss, and the read-back carries exact size
    statistics for the planner.
    """
    return cut_observed(df, name)[0]


def cut_observed(df: DataFrame, name: str = "cut", **metrics: Column) -> tuple[DataFrame, dict]:
    """``cut``, with aggregate metrics (always ``rows``) computed in the same job
    (``DataFrame.observe``) — no extra count job — and the table's ``path``."""
    spark = df.sparkSession
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("rows")] + [
        F.coalesce(expr, F.lit(0)).alias(key) for key, expr in metrics.items()]
    path = scratch_path(spark, name)
    df.observe(obs, *exprs).write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), {**obs.get, "path": path}


def cut_placed(df: DataFrame, name: str = "cut", **metrics: Column) -> tuple[DataFrame, dict]:
    """``cut_observed`` that leaves the rows where they lie: a checkpoint in the
    shared folder, computed once.

    A checkpoint remembers how its rows are partitioned, so a later join or
    aggregation on the same keys with the same partition count needs no
    exchange; a parquet table read back would have to be shuffled again."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("rows")] + [
        F.coalesce(expr, F.lit(0)).alias(key) for key, expr in metrics.items()]
    out = df.observe(obs, *exprs).checkpoint(eager=True)
    path = out._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    _scratch_list(spark).append(path)
    return out, {**obs.get, "path": path}


def replace_table(spark: SparkSession, old: str | None, new: str) -> str:
    """Delete a superseded loop state once the next one is written."""
    if old is not None:
        _forget(spark, old)
    return new


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions for ``rows`` narrow rows: by the counted rows, and as many as
    run at once at least (fewer if the session shuffles into fewer)."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(1, least, ceil(rows / conf_int(spark, CONF_LAYOUT_ROWS)))


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the jobs run inside, restored afterwards."""
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def loop_conf(spark: SparkSession, rows: int = 0):
    """Session conf for the jobs of an iterative operator over ``rows`` edges;
    gives the number of shuffle partitions inside.

    Inside the loops edge joins are planned explicitly (broadcast under a
    counted bound, or an edge layout made once with its hot keys apart) and
    state tables are joined on keys unique on both sides, so AQE's per-stage
    re-planning only adds latency to each of the many small jobs; it is
    switched off for the loop and restored afterwards.  The shuffle partitions
    follow the counted rows, and layouts, states and messages share them, so
    states stay where the edges of their keys are."""
    parts = partitions_for(spark, rows)
    adaptive = spark.conf.get(CONF_LOOP_ADAPTIVE, str(DEFAULTS[CONF_LOOP_ADAPTIVE])).lower()
    with session_conf(spark, {"spark.sql.adaptive.enabled": adaptive, "spark.sql.shuffle.partitions": str(parts)}):
        yield parts


@contextmanager
def shuffle_by_rows(spark: SparkSession, rows: int):
    """Session conf for jobs that shuffle ``rows`` rows: as many shuffle partitions as
    the session has, and more where a task would get more rows than a layout's.
    AQE joins them again up to ``COALESCED`` shuffled bytes only."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(spark, rows))
    with session_conf(spark, {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.advisoryPartitionSizeInBytes": COALESCED}):
        yield parts


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "threadweave") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
