"""Queries of the corpus operators, one for each, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, mixing, repair, sharding, topk, variants
from .common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import edited_likeness

    return edited_likeness(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import removal_digests

    return removal_digests(table(spark, sf_dir, "documents"))


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.windows(turns.unionByName(chat.control_conversation(turns))))


def op2_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op5_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_spans, summarize

    return summarize(find_spans(table(spark, sf_dir, "documents")))


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(table(spark, sf_dir, "conversations"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.vocabulary(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_pu_toxicity": op2_pu_toxicity,
    "op3_bpe_chunk_reuse": op3_bpe_chunk_reuse,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_weak_supervision_pii": op5_weak_supervision_pii,
    "op6_poisson_mixing": op6_poisson_mixing,
    "op7_chunk_fingerprints": op7_chunk_fingerprints,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_chat_windows": op9_chat_windows,
    "op10_hilbert_sharding": op10_hilbert_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_counts": op12_token_counts,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL = {
    "op4_exact_top_k": topk.ORACLE_SQL,
    "op6_poisson_mixing": mixing.ORACLE_SQL,
    "op9_chat_windows": chat.ORACLE_SQL,
    "op10_hilbert_sharding": sharding.ORACLE_SQL,
    "op11_conversation_repair": repair.ORACLE_SQL,
    "op13_spelling_variants": variants.ORACLE_SQL,
}
