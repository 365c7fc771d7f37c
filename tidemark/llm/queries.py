"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, exact_dedup, hard_negatives, lexical_search, mixing, ngram_join, quality, substring_dedup, suffix_dedup, token_counts, token_ids, toxicity, url_filter
from tidemark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


@_register("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_register("op2_suffix_dedup", suffix_dedup.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_register("op3_ngram_join", ngram_join.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir))


@_register("op4_source_mix", mixing.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


@_register("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_register("op6_exact_dedup", exact_dedup.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


@_register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_register("op8_url_filter", url_filter.SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the outcome ``labels.quality = 0`` of the document with the page's id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    rows = url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), outcomes)
    return rows.select("page_id", "host", "path", "rule", "verdict")


@_register("op9_substring_dedup", substring_dedup.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_register("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_register("op11_hard_negatives", hard_negatives.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors (ids divisible by 100) against all embeddings."""
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_register("op12_token_ids")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of byte_bpe_50k, each document ended by id 2, written as Huffman blocks and read back."""
    return token_ids.token_ids(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@_register("op13_lexical_search", lexical_search.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents of all documents."""
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES["pipeline"] = corpus_pipeline.run
