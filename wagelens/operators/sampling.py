"""Orders and samples that do not depend on how the rows are partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.functions.keys import split_digest


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in a fixed random order."""
    return df.orderBy(split_digest(F.col(key), seed), key)


def random_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n random rows, the same ones on every run; each task keeps n at most."""
    return shuffled(df, key, seed).limit(n)


def top_rows(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """The k rows with the highest value; ties by key."""
    return df.orderBy(F.desc(by), key).limit(k)
