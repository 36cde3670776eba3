"""The registered queries opN_<name>: thin digests of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens.llm import bpe, chat, language_id, line_dedup, metric_join, mixing, oracles, resample, sanitise, simhash, spelling, token_counts, topk, url_filters
from wagelens.operators.layout import spread

RULES = (
    url_filters.Rule("allow", "org", "/"),
    url_filters.Rule("block", "example.org", "/es/"),
    url_filters.Rule("block", "example.org", "/en/1"),
    url_filters.Rule("allow", "com", "/fr/"),
    url_filters.Rule("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all cores even where the table is one small file; large tables are read as they lie."""
    return spread(_table(spark, sf_dir, "documents"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(_table(spark, sf_dir, "pages"), RULES)


def op2_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sanitise.find_spans(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", sanitise.listed(F.col("found")).alias("spans"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, decisions = mixing.mix(_documents(spark, sf_dir), alike=False)
    return mixing.decided(rows, decisions).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), shingle_words=4, distance=4)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(_documents(spark, sf_dir))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(_table(spark, sf_dir, "conversations"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_every(_table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64)


def op10_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(_documents(spark, sf_dir)))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_sanitise": op2_sanitise,
        "op3_mixing": op3_mixing,
        "op4_language_id": op4_language_id,
        "op5_simhash": op5_simhash,
        "op6_bpe": op6_bpe,
        "op7_line_dedup": op7_line_dedup,
        "op8_chat_format": op8_chat_format,
        "op9_top_k": op9_top_k,
        "op10_metric_join": op10_metric_join,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_token_counts": op12_token_counts,
        "op13_resample": op13_resample,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
