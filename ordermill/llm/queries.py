"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm.common import table
from ordermill.llm.divergence import divergence_audit
from ordermill.llm.hardneg import mine_hard_negatives
from ordermill.llm.html import extract_main_text
from ordermill.llm.katz import katz_scores
from ordermill.llm.mixing import pfair_mix
from ordermill.llm.neardup import near_duplicates
from ordermill.llm.oracle import divergence_sql, hard_negatives_sql, quality_sql
from ordermill.llm.pieces import encoding_digests
from ordermill.llm.quality import apply_rules
from ordermill.llm.sharding import shuffle_to_shards
from ordermill.llm.tiling import find_contaminated
from ordermill.llm.tokens import section_token_counts
from ordermill.llm.toxicity import held_out, score_texts, train
from ordermill.llm.warc import read_archives, resolved, write_archives
from ordermill.plans.scratch import scratch_dir

SHARDS = 16
#: Target weights of the sources that shall be more than the others, which have weight 1.
MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
TOKENIZER = os.environ.get("TOKENIZER_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
PIECES_MODEL = os.environ.get("TOKENIZER_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    return shuffle_to_shards(documents, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return section_token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_chosen_path_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(documents).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_stop_words",
        "n_letter_words",
    )


def op5_line_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("bigint"))


def op6_zstd_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; archives with fewer than 16 records or 32 KB are written without a dictionary frame."""
    manifest = write_archives(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return resolved(read_archives(manifest, with_payload=False)).select(
        F.col("key").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    return score_texts(documents, model, score="score").select(
        "doc_id",
        held_out(F.col("doc_id"), 5).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 10))


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources to other weights than the rest."""
    return pfair_mix(table(spark, sf_dir, "documents").select("doc_id", "source"), MIX_WEIGHTS)


def op10_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents, with each benchmark item that they cover by half or more."""
    found = find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash", "tiles")


def op11_offset_preserving_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), PIECES_MODEL)


def op12_one_hot_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_hilbert_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_hypergeometric_shards,
        op2_section_token_counts,
        op3_chosen_path_near_duplicates,
        op4_quality_rules,
        op5_line_block_extraction,
        op6_zstd_warc_roundtrip,
        op7_kneser_ney_toxicity,
        op8_katz_backoff,
        op9_pfair_mixing,
        op10_greedy_string_tiling,
        op11_offset_preserving_pieces,
        op12_one_hot_divergence,
        op13_hilbert_hard_negatives,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL = {
    # Sizes and fixed columns of the other operators follow from their methods only; see the tests.
    "op4_quality_rules": quality_sql(),
    "op12_one_hot_divergence": divergence_sql(),
    "op13_hilbert_hard_negatives": hard_negatives_sql(),
}
