"""From raw documents to packed sequences: classify, deduplicate, decontaminate, mask and pack.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns a DataFrame; all but
the last return the columns of documents. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.llm import op1_ngram_join as ngram_join
from fingertrail.llm import op3_pii as pii
from fingertrail.llm import op4_quality_classifier as quality
from fingertrail.llm import op9_decontamination as decontamination
from fingertrail.llm import op10_packing as packing
from fingertrail.llm.common import quoted, small_batches, table
from fingertrail.session import store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay; empty and null texts are scored like all others."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.classify(docs, model)
    score = scored.columns[-1]  # docs may have a column of the usual name
    return scored.filter(F.col(score) >= quality.THRESHOLD).select(*quoted(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links (five-word shingles, Jaccard 0.8 or more) tie, the document of the smallest id stays."""
    return ngram_join.keep_first(docs, words=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in angle brackets; n_chars follows the text."""
    model = pii.fit(docs)
    with small_batches(spark):
        masked = store(pii.mask(docs, model))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*quoted(docs.columns))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per sequence: doc_id, start, length, ids_crc32, the token ids, doc_tokens, sequence_id and offset."""
    with small_batches(spark):
        return store(packing.pack(docs.select("doc_id", "text")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_join", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("packing", sequence_packing),
]

#: Models, tokens and edit distances are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, store(docs) if number else docs, sf_dir)
    return docs
