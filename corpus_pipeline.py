"""From raw documents to packed training sequences, in stages that are stored one after another."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habispark.llm import bpe, exact_dedup, line_crf, minhash, packing, substring
from habispark.llm.tables import read_table, stored

# Near copies share this percentage of their five-word shingles, or more; 85 is only op5's own figure.
NEAR = 80
# Whose tokens fill the bins.
VOCABULARY = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line field reject go."""
    return line_crf.passing(docs, line_crf.train(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.without_copies(docs, largest=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest id stays."""
    return minhash.without_near_copies(docs, threshold=NEAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too are cut; n_chars follows the text."""
    return substring.without_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, in tokens, in bins of the permitted lengths."""
    return packing.packed(bpe.token_counts(docs, public_tokenizers.path(VOCABULARY)))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", drop_boilerplate),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

# The first stage is a trained sequence model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each one reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
