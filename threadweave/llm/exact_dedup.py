"""Operator 6 - exact duplicates with an extendible-hash index on shared files.

Texts are equal when identical after every run of white space
``[\\x20\\x09-\\x0D]`` becomes one space.  Each text has a 64-bit key.  The
index is a directory over key prefixes: it starts with one bucket, doubles
its depth while a bucket holds more keys than ``capacity``, and splits only
overfull buckets, so buckets are key ranges of about equal size.  Owner tasks
take whole buckets in key order, chain the entries of equal keys, compare
their bytes and write index entries (bucket, key, place in chain, sha256,
smallest doc_id, rows) as files in the shared folder.  A look-up joins rows
with index entries on key and digest.

Scale: only (key, doc_id, digest) rows and the texts of keys seen twice are
shuffled; copies are combined on the map side first, so a group with a third
of all rows reaches its owner as one row per task.  The driver sees the
directory's counts (a bounded number, as the capacity grows beyond 4096 full
buckets), no keys and no texts.  The
final join's hot keys are left to AQE's skew splitting.

Defined results: null counts as empty text, and empty texts are equal to each
other; repeated rows count as copies and each gets a row (all with the kept
doc_id are kept); rows with a null ``doc_id`` count in a group, and are kept
only if the whole group has none; an empty table gives no rows; other columns
are ignored (``drop_copies`` passes them on); ties do not arise, as the smallest id
stays; a very long text is compared byte by byte like any other, one at a time.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadweave.llm.tables import Workspace, small, without_rows
from threadweave.llm.textcols import id_text

SPACES = r"[\x20\x09-\x0D]+"
BITS = 64


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.regexp_replace("text", SPACES, " ")
    return id_text(docs).select("doc_id", text.alias("norm")).withColumn("key", F.xxhash64("norm"))


def _slot(depth: int):
    """First ``depth`` bits of the key as a number."""
    return F.expr(f"shiftrightunsigned(key, {BITS - depth})") if depth else F.lit(0).cast("long")


class Directory:
    """Bucket bounds over the unsigned key space; grown by doubling.

    ``capacity`` is raised so that ``n_keys`` keys need about ``MOST`` buckets
    at most, so neither the counts nor the bounds grow with the corpus: owner
    tasks stream their buckets, whatever these hold.  Doublings that so many keys
    must take are counted in the first job."""

    STEP = 6  # bits counted ahead in one job, i.e. up to six doublings
    MOST = 4096

    def __init__(self, keys: DataFrame, capacity: int, n_keys: int = 0):
        capacity = max(capacity, -(-n_keys // self.MOST))
        self.buckets: list[tuple[int, int]] = []  # (prefix, local depth) of finished buckets
        open_, depth = {(0, 0)}, 0
        while open_:
            ahead = depth + self.STEP if depth else max(self.STEP, (n_keys // capacity).bit_length() + 2)
            parents = {p for p, _ in open_}
            rows = keys if not depth else keys.filter(_slot(depth).isin([int(p) for p in parents]))
            count = {r["slot"]: r["n"] for r in rows.groupBy(_slot(ahead).alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
            open_ = set()
            for p in parents:
                open_ |= self._split(p, depth, ahead, count, capacity)
            depth = ahead
            if depth >= 60:  # 2**-60 of the key space: more keys than that share a prefix only as equal keys
                self.buckets += open_
                break
        self.bounds = sorted(p << (BITS - d) for p, d in self.buckets)

    def _split(self, prefix: int, depth: int, ahead: int, count: dict[int, int], capacity: int) -> set[tuple[int, int]]:
        width = ahead - depth
        n = sum(count.get((prefix << width) + i, 0) for i in range(1 << width))
        if n <= capacity:
            self.buckets.append((prefix, depth))
            return set()
        if depth == ahead:
            return {(prefix, depth)}
        return self._split(2 * prefix, depth + 1, ahead, count, capacity) | self._split(2 * prefix + 1, depth + 1, ahead, count, capacity)

    def bucket(self, key: int) -> int:
        return bisect_right(self.bounds, key % (1 << BITS)) - 1

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of its key's bucket."""
        bounds = np.array(self.bounds, np.uint64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                key = b["key"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                yield b.append_column("bucket", pa.array(np.searchsorted(bounds, key, side="right") - 1, pa.int64()))

        return df.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in df.schema)}, bucket long")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner task: entries come sorted by key; equal keys are chained, and an
    entry joins the link whose bytes equal its own."""
    key, links = None, []
    for b in batches:
        out = []
        for r in b.to_pylist():
            if r["key"] != key:
                out += links
                key, links = r["key"], []
            for link in links:
                if link["norm"] == r["norm"]:
                    ids = [x for x in (link["keep_id"], r["keep_id"]) if x is not None]
                    link["keep_id"] = min(ids, default=None)
                    link["group_size"] += r["group_size"]
                    break
            else:
                links.append(r | {"chain": len(links)})
        if out:
            yield _entries(out)
    if links:
        yield _entries(links)


def _entries(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("bucket", pa.int64()), ("key", pa.int64()), ("chain", pa.int64()), ("sha", pa.string()), ("keep_id", pa.int64()),
        ("group_size", pa.int64())]))


def build_index(docs: DataFrame, work: Workspace, capacity: int = 20_000) -> tuple[DataFrame, DataFrame, int]:
    """Rows (doc_id, key, sha), the index files read back, and the number of entries for copies."""
    rows, _ = work.write(_keyed(docs).select("doc_id", "key", F.sha2("norm", 256).alias("sha")), "rows")
    keys, n_keys = work.write(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"),
                                                     F.min("sha").alias("sha")), "keys")
    directory = Directory(keys, capacity, n_keys)
    twice = keys.filter("n > 1").select("key")
    n_twice = twice.count()
    one = keys.filter("n = 1").select("key", F.lit(None).cast("string").alias("norm"), "sha",
                                      F.col("first").alias("keep_id"), F.col("n").alias("group_size"))
    more = (_keyed(docs).join(small(twice, n_twice), "key", "left_semi").groupBy("key", "norm")
            .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("key", "norm", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"))
    owners = max(1, min(len(directory.bounds), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    placed = directory.assign(one.unionByName(more)).repartitionByRange(owners, "bucket").sortWithinPartitions("bucket", "key", "keep_id")
    index, _ = work.write(placed.mapInArrow(_chain, "bucket long, key long, chain long, sha string, keep_id long, group_size long"), "index")
    work.drop("keys")
    return rows, index, n_twice


def exact_duplicates(docs: DataFrame, capacity: int = 20_000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    work = Workspace(docs.sparkSession, "exact-dedup")
    rows, index, n_twice = build_index(docs, work, capacity)
    copies = index.filter("group_size > 1").select("key", "sha", "keep_id", "group_size")
    found = rows.join(small(copies, n_twice), ["key", "sha"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, capacity: int = 20_000) -> DataFrame:
    """The rows of ``docs`` without the copies (all columns); rows with a null
    ``doc_id`` stay, and a row goes for its own text, not for another of its id."""
    work = Workspace(docs.sparkSession, "exact-dedup")
    judged, _ = work.write(exact_duplicates(docs, capacity).select("doc_id", F.col("text_sha256").alias("mark"), "kept"), "judged")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return without_rows(docs, judged, F.sha2(F.regexp_replace(text, SPACES, " "), 256), work)
