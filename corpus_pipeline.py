"""A corpus cleaning pipeline: every stage works on all that the one before it kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.

Defined results: a null or empty text fails the quality rules and goes there;
texts of any length are judged, compared and packed whole; rows with a null id
are judged like others, are no one's near-duplicate and are packed; repeated
rows (same id) count as one document for near-duplicates, so all of them stay
or go together, and each is packed; of a group of near-duplicates the smallest
id stays, so ties cannot arise; extra columns of any name pass through all
stages but the last, which has columns of its own; an empty table gives no
rows, and without labels the classifier and the bands keep what their
docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farebox.llm import compression_bands, compression_classifier, genetic_packing, minhash_dedup
from farebox.llm.common import fold, read_table
from farebox.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep; the bands
    are fitted on documents of the tables that are labelled good."""
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1")
    return compression_bands.keep_good(docs, compression_bands.fit_bands(read_table(spark, sf_dir, "documents"), trusted))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good; it is fitted
    on labelled rows of the tables, a fifth of which it never sees."""
    labels = read_table(spark, sf_dir, "labels").where(fold(5) != 0)
    model = compression_classifier.fit(read_table(spark, sf_dir, "documents"), labels)
    return compression_classifier.keep_predicted(docs, model, threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: shingles of five words, similarity 0.8 or more."""
    return minhash_dedup.drop_near_duplicates(docs, words_per_shingle=5, threshold_percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return genetic_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

# zstandard, a fitted classifier and tokenization are beyond SQL; the stages
# are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage's result is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
