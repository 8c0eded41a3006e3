"""Corpus pipeline: from raw documents to packed training sequences.

Stages, each over all that its predecessor kept: quality rules reject
documents; of equal documents one stays, of near duplicates one of each
group; secrets are masked in the text; what remains is tokenized and packed.  Each stage's result is written as Parquet in the shared folder and
read back as the next stage's input, so a lost executor costs one stage's
tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadweave.llm.exact_dedup import drop_copies
from threadweave.llm.near_dedup import keep_one
from threadweave.llm.packing import pack_documents
from threadweave.llm.quality_rules import keep_good
from threadweave.llm.queries import BYTE_BPE_RANKS, documents
from threadweave.llm.secret_scan import mask_secrets
from threadweave.runtime import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 4)."""
    return keep_good(docs.select(*COLUMNS))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest id (operator 6)."""
    return drop_copies(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles,
    similarity 0.8 or more (operator 10)."""
    return keep_one(docs.select(*COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked (operator 7)."""
    return (mask_secrets(docs.select(*COLUMNS))
            .withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences (operator 2)."""
    return pack_documents(docs, BYTE_BPE_RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: SQL has no suffix arrays, signatures or tokenizers; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
