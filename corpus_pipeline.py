"""A corpus pipeline over ``documents``: every stage works on all that the one before it kept.

A stage takes and returns the columns of ``documents``; the last one returns token pieces and their
places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from colophon.llm import jaccard_join, language, packing, secret_scan, substring_dedup
from colophon.llm.queries import TOKENIZER
from colophon.session import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language identification rejects; trained on what it is given."""
    model = language.train(language.training_rows(docs))
    named = language.classify(docs, model)
    return named.filter(~F.col("rejected")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_per_class(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut out; ``n_chars`` follows the
    text. Documents of which nothing is left go."""
    cut = substring_dedup.dedup_substrings(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    kept = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]
# Trained centroids and token ids are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order, from the whole table ``documents``; each one's result is written
    to the shared folder and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
