"""Keeping one row per posting.

Each form is one aggregation with a partial step before the shuffle: every map
task sends at most one row per key, so a key with a third of all rows is no hot
spot (a ranking window would pull all its rows into one task).
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.functions.keys import posting_key
from wagelens.operators.components import connected


def _one_per_key(df: DataFrame, key: Column, order: Column, latest: bool) -> DataFrame:
    pick = F.max_by if latest else F.min_by
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key.alias("_key")).agg(pick(row, order).alias("_row")).select("_row.*")


def first_seen(df: DataFrame, key: str, seq: list[str]) -> DataFrame:
    """The earliest row of every key; ``seq`` must order the rows of a key fully."""
    return _one_per_key(df, F.col(key), F.struct(*seq), latest=False)


def across_sources(
    df: DataFrame,
    snapshot: str,
    seq: str,
    url: str = "url",
    identity: tuple[str, ...] = ("title", "company", "location", "salary"),
) -> DataFrame:
    """The row of the newest snapshot per posting, whatever its source."""
    key = posting_key(F.col(url), *[F.col(c) for c in identity if c in df.columns])
    return _one_per_key(df, key, F.struct(snapshot, seq), latest=True)


def _number(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def distinct_seed(df: DataFrame, keys: list[str], seeds: Iterable[int] | None = None) -> int:
    """The first seed whose ``_number`` tells all values of the key columns apart, as a digest of them shows."""
    every = df.select(F.explode(F.array_compact(F.array(*keys))).alias("key")).withColumn("digest", F.xxhash64(F.sha2("key", 256)))
    for seed in count() if seeds is None else seeds:
        numbered = every.groupBy(_number(F.col("key"), seed).alias("n")).agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
        if numbered.where("least <> most").isEmpty():
            return seed
    raise ValueError("no seed tells the keys apart")


def linked_across_sources(
    df: DataFrame,
    snapshot: str,
    seq: str,
    url: str = "url",
    identity: tuple[str, ...] = ("title", "company", "location", "salary"),
) -> DataFrame:
    """The newest row of every posting, where either an address or equal content makes rows one posting.

    Rows with one address are one posting, rows with one content too, and so on from row to
    row: a copy without an address meets the one that has it, also if an edit of that one
    came between.  Content is the ``identity`` columns as they are; a row whose ``identity``
    is all null has none, and one with neither address nor content is a posting of its own.
    ``seq`` must order the rows of a snapshot fully.  Addresses and contents are linked by
    numbers that tell them apart, which are a fraction of their size in every round.
    """
    fields = [F.col(c) for c in identity if c in df.columns]
    content = F.when(F.coalesce(*fields).isNotNull(), F.concat(F.lit("c"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))
    address = F.concat(F.lit("a"), F.col(url))
    texts = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), address.alias("a"), content.alias("b"))
    seed = distinct_seed(texts, ["a", "b"])
    number = {c: F.when(F.col(c).isNotNull(), _number(F.col(c), seed)) for c in ("a", "b")}
    keyed = texts.withColumns(number)
    roots = connected(keyed.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL"))
    own = F.coalesce("a", "b")
    alone = F.concat(F.lit("r"), F.to_json(F.struct(F.col(f"row.{snapshot}"), F.col(f"row.{seq}"))))
    # one row a key on the right: a frequent key is split
    joined = keyed.withColumn("key", own).join(roots.select(F.col("node").alias("key"), "root").hint("merge"), "key", "left")
    name = F.coalesce(F.coalesce("root", "key").cast("string"), alone)
    order = F.struct(F.col(f"row.{snapshot}"), F.col(f"row.{seq}"))
    return joined.groupBy(name.alias("name")).agg(F.max_by("row", order).alias("row")).select("row.*")
