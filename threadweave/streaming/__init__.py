"""Incremental ingestion of the prep step with Structured Streaming.

The original prep is a batch job over a list of month folders.  When new
months keep arriving, the same prep (filters, Java-hash ids, trimming) runs
as a file-stream query: each trigger picks up only new parquet files, and
the streaming checkpoint (in the shared checkpoint folder) records which
files are done, so a restarted or failed job resumes without re-reading or
duplicating months.  Output is the month-partitioned prepped table that every
later stage reads.  No state is kept beyond the file log: prep is row-wise.
"""

from threadweave.streaming.ingest import start_prep_stream

__all__ = ["start_prep_stream"]
