"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm import (
    collocations,
    packing,
    quality_classifier,
    quality_rules,
    sentencepiece,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    suffix_tree,
    token_files,
    url_filter,
    vector_dedup,
)
from salesmill.llm.common import ship, table
from salesmill.sources.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select(
        "row.doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.round_trip(docs, path).withColumnRenamed("key", "doc_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "tokens")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_files.write(token_files.encode(docs, vocabulary), folder)
    return token_files.documents(token_files.read(spark, folder)).withColumnRenamed(
        "key", "doc_id"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(docs, vocabulary).select(
        F.col("key").alias("doc_id"),
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_simhash_dedup": op1_simhash_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_sharding": op5_sharding,
        "op6_url_filter": op6_url_filter,
        "op7_token_files": op7_token_files,
        "op8_packing": op8_packing,
        "op9_vector_dedup": op9_vector_dedup,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_lm_scoring": op11_lm_scoring,
        "op12_collocations": op12_collocations,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": pipeline,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": quality_rules.SQL,
        "op9_vector_dedup": vector_dedup.SQL,
        "op12_collocations": collocations.SQL,
    }
