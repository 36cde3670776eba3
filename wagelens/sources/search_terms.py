"""What is searched for: the seed table and its addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens import rules
from wagelens.functions.text import search_url
from wagelens.operators.sampling import shuffled


def search_terms(spark: SparkSession) -> DataFrame:
    """(category, search_term, seq) for all 63 terms, in listed order."""
    rows = [(i, c, titles) for i, (c, titles) in enumerate(rules.SEARCH_TITLES.items())]
    seeds = spark.createDataFrame(rows, "c_no int, category string, titles array<string>")
    flat = seeds.select("c_no", "category", F.posexplode("titles").alias("t_no", "search_term"))
    return flat.select(
        "category", "search_term", (F.col("c_no") * 100 + F.col("t_no")).alias("seq")
    )


def with_search_url(df: DataFrame, term: str = "search_term") -> DataFrame:
    return df.withColumn("search_url", search_url(F.col(term)))


def with_category(df: DataFrame) -> DataFrame:
    """Attach the category of each row's search term (63 rows, broadcast)."""
    terms = search_terms(df.sparkSession).select("search_term", "category")
    return df.join(F.broadcast(terms), "search_term", "left")


def search_order(spark: SparkSession, seed: int) -> DataFrame:
    """The terms in a fixed random order."""
    return shuffled(search_terms(spark), "search_term", seed)
