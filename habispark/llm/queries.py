"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from habispark.llm import (
    bpe,
    conversation_repair,
    exact_dedup,
    filter_audit,
    lattice_dedup,
    line_crf,
    link_trust,
    minhash,
    packing,
    pitman_yor,
    quality_qda,
    substring,
    toxicity_gru,
)
from habispark.llm.tables import read_table


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the quadratic discriminant."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_qda.scored(docs, read_table(spark, sf_dir, "labels"))


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the rules and the line field."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return line_crf.ruled(docs, line_crf.train(docs, read_table(spark, sf_dir, "labels")))


def op3_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, and trust spread over host links, for every page."""
    return link_trust.judged(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the recurrent network."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity_gru.scored(docs, read_table(spark, sf_dir, "labels"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets agree to 85 %."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with a public byte-level vocabulary and decoded again."""
    return bpe.encoded(
        read_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.duplicate_groups(read_table(spark, sf_dir, "documents", "doc_id", "text"), largest=True)


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the model of the training documents."""
    return pitman_yor.scored(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in tokens of a public vocabulary, in bins of four lengths."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.packed(bpe.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in windows of 50 that a document with a smaller id has too are removed."""
    return substring.removed_words(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, in all orders, by source."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return filter_audit.audited(docs, read_table(spark, sf_dir, "labels"))


def op12_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return lattice_dedup.near_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return conversation_repair.damaged_and_repaired(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_qda,
        op2_line_rules,
        op3_link_trust,
        op4_toxicity_gru,
        op5_minhash_dedup,
        op6_bpe_tree,
        op7_exact_dedup,
        op8_pitman_yor,
        op9_best_fit_packing,
        op10_substring_dedup,
        op11_filter_audit,
        op12_lattice_dedup,
        op13_conversation_repair,
    )
}
