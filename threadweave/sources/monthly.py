"""Month-folder sources (one parquet folder per month).

The original layout is ``<dir>/<prefix>-<MM>`` per month.  Each folder is read
on its own with its month as a literal and the frames are united by column
name, so months whose raw schema drifts (extra or re-ordered columns) line up,
no footer of another month is opened to merge schemas, and a filter on the
month drops whole folders from the plan.  Prepped tables are written
partitioned by month so later reads prune partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.schema import MONTH_COL


def month_paths(base_dir: str, prefix: str, months: Sequence[str]) -> list[str]:
    return [f"{base_dir.rstrip('/')}/{prefix}-{m}" for m in months]


def read_month_folders(spark: SparkSession, base_dir: str, prefix: str, months: Sequence[str] | str) -> DataFrame:
    """Several month folders as one DataFrame with a ``month`` column.

    ``months`` is a list or the comma-separated form ``"08,09,10"``."""
    if isinstance(months, str):
        months = [m for m in months.split(",") if m]
    frames = [spark.read.parquet(path).withColumn(MONTH_COL, F.lit(m))
              for m, path in zip(months, month_paths(base_dir, prefix, months), strict=True)]
    return union_months(frames)


def write_month_folders(df: DataFrame, base_dir: str, prefix: str, months: Sequence[str]) -> None:
    """One folder per month, without the month column (the layout that
    ``read_month_folders`` reads)."""
    for m, path in zip(months, month_paths(base_dir, prefix, months), strict=True):
        df.filter(F.col(MONTH_COL) == m).drop(MONTH_COL).write.parquet(path)


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Union per-month frames by column name (missing columns become null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_prepped(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Read a month-partitioned prepped table; the month filter prunes partitions."""
    df = spark.read.parquet(path)
    return df if months is None else df.filter(F.col(MONTH_COL).isin(list(months)))
