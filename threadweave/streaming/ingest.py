"""File-stream version of the prep step (``readStream`` -> prep -> ``writeStream``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from threadweave.operators import prep
from threadweave.schema import MONTH_COL


def start_prep_stream(spark: SparkSession, source_dir: str, schema: StructType, output_dir: str,
                      kind: str = "comments", allow: Iterable[str] | None = None,
                      checkpoint: str | None = None, available_now: bool = True,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Prep raw posts or comments as they land in ``source_dir``.

    ``schema`` is the raw schema (file streams need it up front).  With
    ``available_now`` the query processes everything present and stops
    (incremental batch); otherwise it keeps polling.

    The stream's checkpoint belongs to its output: unless given, it lies in a
    hidden folder under ``output_dir``, so a later call with the same output
    goes on where the last one stopped.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.parquet(source_dir)
    if kind == "comments":
        out = prep.prep_comments(raw, allow)
    elif kind == "posts":
        out = prep.prep_submissions(raw, allow)
    else:
        raise ValueError("kind must be 'comments' or 'posts'")
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or f"{output_dir.rstrip('/')}/_prep_checkpoint"))
    if MONTH_COL in out.columns:
        writer = writer.partitionBy(MONTH_COL)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(output_dir)
