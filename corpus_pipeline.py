"""A training-data pipeline over ``documents``: each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wagelens.llm import bpe, language_id, line_dedup, mixing, simhash
from wagelens.llm.staging import stage
from wagelens.operators.layout import spread

#: least share of a text's letters that its language must have
LEAST_LANGUAGE_SHARE = 0.25


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; without letters, or with no language for a quarter of them, they go."""
    return language_id.keep_identified(docs, LEAST_LANGUAGE_SHARE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of passages of whole lines."""
    return line_dedup.dedup_lines(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle_words=4, distance=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs, alike=False)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: SQL has neither the model nor XXH64 nor the tokenizer; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; a small table is spread over all cores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, spread(docs), sf_dir), name)
    return STAGES[-1][1](spark, spread(docs), sf_dir)
