"""Joins to small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most this many rows; reads no more than needed."""
    return df.limit(rows + 1).count() <= rows


def join_lookup(df: DataFrame, lookup: DataFrame, on: str, how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a lookup table: broadcast if measured small, else a shuffled join.

    The shuffled form leaves hot keys to adaptive skew splitting.
    """
    side = F.broadcast(lookup) if small_enough(lookup, rows) else lookup
    return df.join(side, on, how)


def value_or_default(df: DataFrame, lookup: DataFrame, on: str, value: str, default: Column) -> DataFrame:
    """Dictionary lookup with a default."""
    return join_lookup(df, lookup, on).withColumn(value, F.coalesce(F.col(value), default))


def members(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is listed."""
    return join_lookup(df, keys.select(on).distinct(), on, "left_semi")


def attach_group_value(df: DataFrame, groups: DataFrame, on: str) -> DataFrame:
    """Give every row the aggregate of its group."""
    return join_lookup(df, groups, on)
