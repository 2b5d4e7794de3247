"""A training corpus from the documents table: five stages, each over all that the one before kept.

Every stage but the last returns the columns of documents; the last returns token pieces and their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomline.llm import exact_dedup, jaccard, mixing, packing, quality
from loomline.llm.common import staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' vote rejects go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to white space, the row with the smallest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on five-word shingles stays."""
    return jaccard.one_per_component(docs, words=5, percent=80)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's words: a row for each pass over a source that takes words of a document."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows, placed in sequences of 2048 tokens."""
    return packing.best_fit_pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, with_ids=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_deduplication),
    ("n-gram Jaccard join", near_deduplication),
    ("mixing", mix_to_weights),
    ("best-fit packing", pack_sequences),
]

#: None: stages 1, 3, 4 and 5 can't be said in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each one's result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
