"""Keys that decide identity, order and split of postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagelens import rules


def posting_key(url: Column, *identity: Column) -> Column:
    """The url, or a digest of the identifying fields where there is none."""
    parts = [F.coalesce(c, F.lit("")) for c in identity]
    return F.coalesce(url, F.md5(F.concat_ws("|", *parts)))


def split_digest(key: Column, seed: int = rules.SPLIT_SEED) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def split_side(key: Column, seed: int = rules.SPLIT_SEED) -> Column:
    """'test' for one fifth of the keys, else 'train'; copies share a side."""
    head = F.substring(split_digest(key, seed), 1, 8)
    return F.when(head < F.lit("33333333"), F.lit("test")).otherwise(F.lit("train"))


def fold_of(key: Column, folds: int, seed: int = rules.SPLIT_SEED) -> Column:
    """Fold number from another part of the digest than the split uses."""
    part = F.substring(split_digest(key, seed), 9, 7)
    return F.conv(part, 16, 10).cast("int") % F.lit(folds)
