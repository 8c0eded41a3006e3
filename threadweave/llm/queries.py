"""The registered ``opN_<name>`` queries: thin uses of the operators over the
whole ``documents`` table, with the columns that their contracts name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadweave.llm.exact_dedup import SPACES, exact_duplicates
from threadweave.llm.lm_scoring import lm_scores
from threadweave.llm.near_dedup import NearRules, near_duplicates
from threadweave.llm.oracle import OP5, OP8, OP10, OP11, OP13
from threadweave.llm.packing import pack_documents
from threadweave.llm.piece_sampling import sample_pieces
from threadweave.llm.quality_rules import quality_rules
from threadweave.llm.secret_scan import scan_secrets
from threadweave.llm.simhash import simhash_groups
from threadweave.llm.spelling import spelling_variants
from threadweave.llm.substring_dedup import remove_repeated_spans
from threadweave.llm.suffix_dedup import remove_repeats
from threadweave.llm.token_counts import token_counts
from threadweave.llm.turn_repair import damage, repair_turns

BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), PIECE_MODEL)


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), BYTE_BPE_RANKS)


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(documents(spark, sf_dir), PIECE_MODEL)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir)).drop("found")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op9_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir), BYTE_BPE_RANKS)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), NearRules(shingle=3, num=85, den=100))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), shingle=3)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_turns(damage(conversations(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_vector_packing, op3_piece_sampling, op4_quality_rules, op5_substring_dedup, op6_exact_dedup,
                              op7_secret_scan, op8_suffix_dedup, op9_attention_lm, op10_minhash_near_dedup,
                              op11_spelling_variants, op12_simhash_near_dedup, op13_turn_repair)}

ORACLE: dict[str, str] = {
    "op6_exact_dedup": rf"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY norm)""",
    "op5_substring_dedup": OP5,
    "op8_suffix_dedup": OP8,
    "op10_minhash_near_dedup": OP10,
    "op11_spelling_variants": OP11,
    "op13_turn_repair": OP13,
}
