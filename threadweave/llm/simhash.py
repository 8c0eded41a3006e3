"""Operator 12 - SimHash near-duplicates by multi-index hashing.

A document's fingerprint has 64 bits: each shingle of ``shingle`` lower-cased
words (repeats included, joined by one space) is hashed with XXH64, and a bit
is set if it is set in more than half of the hashes.  Fingerprints link at two
or fewer differing bits.

Multi-index hashing: the fingerprint has two segments of 32 bits, each with a
table of its values.  Two fingerprints within two bits either agree in a
segment or differ by one bit in each, so searching the first segment's table
with the Hamming ball of radius 1 around a fingerprint's own segment, and the
second segment's with the value itself, meets every pair.  (Of a pair that
differs in the first segment only the end with the smaller value searches.)
Matches are fetched by a join on (segment, value) and verified by their
complete distance.

A bucket that holds more than ``bucket`` rows (many fingerprints with a common
segment) isn't compared pair by pair: its table rows enumerate the Hamming ball
of radius 1 in their other segment as well, and a search from outside has
spent one bit already and gives its other segment as it is.  Rows that meet at
such a point are each within one bit of it, so they are within two bits of
each other, and linking all of them to the smallest loses no connection; two
rows of the bucket within two bits always share a point.  At most 65 distinct
fingerprints can meet at a point.  Rows therefore grow with the fingerprints
and never with the square of a bucket.

Scale: texts are read once and not shuffled; equal fingerprints (copies) are
one row from then on, combined on the map side; about 18 narrow rows for each
distinct fingerprint are shuffled.  Components come from hooking smallest
labels over the links in written rounds.

Defined results: null and empty texts have the fingerprint zero, which is
linked like any other; a text shorter than a shingle is hashed whole; repeated
rows and ``doc_id``s each give a row; a row with a null ``doc_id`` counts by its
fingerprint, but does not name a component (null if no member has an id); ties
do not arise, as half of the hashes is not over half; a very long text is
hashed in chunks, so it needs memory for its words only; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadweave.llm.near_dedup import components
from threadweave.llm.tables import Workspace, small
from threadweave.llm.textcols import id_text, slices

SEED = 42
HALF = 32
#: Shingles whose bits are counted at once (64 bytes each).
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit fingerprint of a text (0 without words)."""
    parts = text.encode().lower().split()  # bytes: A-Z only, and the six white-space bytes
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(parts))
    begins, ends = begins[:len(parts) - k + 1], ends[k - 1:]
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(begins), CHUNK):
        pieces = zip(begins[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in pieces], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(begins), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp) for each row, ``fp`` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fp = [fingerprint(t, shingle) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def _flips(value: Column) -> Column:
    """``value`` (32 bits in a long) with each of its bits turned over."""
    return F.transform(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda b: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _index(fps: DataFrame) -> DataFrame:
    """Rows (s, v, fp, own): the table entries of both segments (own) and the
    ball searches in the first segment's table."""
    low = F.lit((1 << HALF) - 1)
    seg = fps.select("fp", F.shiftrightunsigned("fp", HALF).alias("first"), F.col("fp").bitwiseAND(low).alias("second"))

    def entry(s: int, v: Column, own: bool) -> Column:
        return F.struct(F.lit(s).alias("s"), v.alias("v"), F.lit(own).alias("own"))

    ball = F.filter(_flips(F.col("first")), lambda v: v > F.col("first"))
    rows = F.concat(F.array(entry(0, F.col("first"), True), entry(1, F.col("second"), True)),
                    F.transform(ball, lambda v: entry(0, v, False)))
    return seg.select("fp", F.explode(rows).alias("e")).select("fp", "e.*")


def near_fingerprints(fps: DataFrame, work: Workspace, bucket: int = 128) -> tuple[DataFrame, int]:
    """Links (a, b) between distinct fingerprints (``fp``) of distance at most 2
    whose connected components are those of all such pairs; and their number."""
    rows = _index(fps)
    sizes = (rows.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("home"))
             .filter("home AND n > 1").select("s", "v", (F.col("n") > bucket).alias("hot")))
    met, n_met = work.write(sizes, "buckets")
    hits, _ = work.write(rows.join(small(met, n_met), ["s", "v"]), "hits")
    cold, hot = hits.filter("NOT hot"), hits.filter("hot")
    a = cold.filter("own").select("s", "v", F.col("fp").alias("a"))
    b = cold.select("s", "v", F.col("fp").alias("b"), "own")
    # a search finds entries of another bucket, so it never finds itself; two entries meet once
    pairs = a.join(b, ["s", "v"]).filter((~F.col("own") | (F.col("a") < F.col("b"))) & (_distance("a", "b") <= 2)).select("a", "b")
    other = F.when(F.col("s") == 0, F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1))).otherwise(F.shiftrightunsigned("fp", HALF))
    points = F.when(F.col("own"), F.concat(F.array(other), _flips(other))).otherwise(F.array(other))
    at = hot.select("s", "v", "fp", F.explode(points).alias("point"))
    least = at.groupBy("s", "v", "point").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).filter("a <> top").drop("top")
    stars = at.join(least, ["s", "v", "point"]).filter((F.col("fp") != F.col("a")) & (_distance("fp", "a") <= 2)).select("a", F.col("fp").alias("b"))
    return work.write(pairs.unionByName(stars).distinct(), "links")


def simhash_groups(docs: DataFrame, shingle: int = 5, bucket: int = 128) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    work = Workspace(docs.sparkSession, "simhash")
    marked, _ = work.write(fingerprints(docs, shingle), "fingerprints")
    fps, _ = work.write(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    links, n_links = near_fingerprints(fps.select("fp"), work, bucket)
    named = fps.select("fp", F.col("first").alias("component_id"))
    if n_links:
        label, n = components(links, work, "cc")
        parts = fps.join(small(label.withColumnRenamed("rep", "fp"), n), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
        parts, _ = work.write(parts, "parts")
        names = parts.groupBy("comp").agg(F.min("first").alias("component_id"))
        named = parts.join(names, "comp").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
