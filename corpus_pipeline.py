"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept and returns the columns
of documents; the last returns placed pieces. ``run`` writes every stage's result as Parquet to the
shared folder and reads it again, so a lost executor repeats tasks of one stage only.

Null and empty texts have no words: the classifier drops them, and each other stage on its own takes
them as empty texts. Rows are kept or dropped, not ids, so rows that share an id live on side by side if
their texts differ; null ids stay null. Columns beyond those of documents pass through all stages but
the last under their own names. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm import packing, quality_classifier, quality_rules, simhash, substring_dedup
from salesmill.llm.common import ship, stash, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    ship(spark)
    return quality_classifier.keep(docs)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest id: four-word shingles, at most
    four bits apart. Rows of one id are copies only if their texts are alike.
    """
    ship(spark)
    return simhash.keep(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes or more that occur earlier.

    Every row stays, if need be with an empty text; a null text becomes an empty one. Of rows with equal
    ids and texts none counts as earlier than the other. ``n_chars`` is counted again.
    """
    ship(spark)
    cut = substring_dedup.keep(docs)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens.

    An empty or null text is the end token alone. Rows that share an id have pieces each.
    """
    ship(spark)
    # Workers still hold what earlier stages left them: a smaller cache than alone.
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    placed = packing.packed(docs, vocabulary, remembered=100_000)
    return placed.withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("packing", pack),
]

#: Tokenizers, trained scorers and hashes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
