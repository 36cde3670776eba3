"""Importance resampling towards a target distribution.

Features are word n-grams hashed to buckets.  A bucket's gain is how much likelier it is
in the target than in the documents; gains are one array, and a document's weight is the
mean of the array at its features.  Weights with Gumbel noise from the doc_id are scores;
the documents of highest score are drawn.

The cutoff is found without sorting the documents: every task names the median of its
keys, and the median of those, weighted by the keys behind each, has at least a quarter
of all keys on either side.  One side goes, and the next round has that much less, until
what remains is small.  Only the winners are sorted.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.staging import stage
from wagelens.session import ship_package

BUCKETS, LONGEST_GRAM = 10_000, 2
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: keys sorted at once for a median, and at the end on the driver
BLOCK, SMALL = 1 << 20, 1 << 13
#: bytes of a text split at once
PIECE = 1 << 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # after lower-casing; bytes of longer characters all belong
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text with A-Z in lower case, some at a time."""
    data = text.encode("utf-8", "replace").lower()
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        yield _WORD.findall(data, at, end)
        at = end


def buckets_of(text: str, longest: int, buckets: int) -> Iterator[np.ndarray]:
    """Bucket of every n-gram of 1 to ``longest`` words, some at a time: the CRC-32 of its words with single spaces.

    The CRC of a gram goes on from that of its words but the last, so no gram is written out.
    """
    tail: list[bytes] = []  # words before these whose grams go on into them
    for words in words_of(text):
        n, words = len(tail), tail + words
        crcs = list(map(zlib.crc32, words))
        ends = range(len(words))
        for k in range(1, longest + 1):  # crcs[i] is of the k words from i; those wholly in the tail were counted before
            new = max(0, n - k + 1)
            yield np.array(crcs[new:], np.int64) % buckets
            more = words[k:]
            crcs = list(map(zlib.crc32, more, map(zlib.crc32, repeat(b" "), crcs[: len(more)])))
        tail = words[len(words) - longest + 1 :] if longest > 1 else []


def count_features(docs: DataFrame, longest: int = LONGEST_GRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket, empty ones left out; one row a task and bucket is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for found in buckets_of(text.as_py() or "", longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    ship_package(docs.sparkSession)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST_GRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, a thousandth of a natural logarithm each; two counts a bucket reach the driver."""
    table = np.zeros((2, buckets), np.int64)
    for side, texts in enumerate((docs, target)):
        for row in count_features(texts, longest, buckets).collect():
            table[side, row["bucket"]] = row["n"]
    (s, t), (all_s, all_t) = table.astype(float), table.sum(axis=1).astype(float)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_GRAM) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight): one row per row of ``docs``."""
    table = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(2):
                n_words = n = total = 0
                for at, found in enumerate(buckets_of(text.as_py() or "", longest, len(table.value))):
                    n_words += len(found) if at % longest == 0 else 0
                    n += len(found)
                    total += int(table.value[found].sum())
                rows.append((n_words, n, total // n if n else 0))
            numbers = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers], ["doc_id", "text_hash", "n_words", "n_features", "weight"])

    ship_package(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from the seed and doc_id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


#: in drawing order: falling score, then rising doc_id with null last; then what tells rows apart
KEY = ("neg", "no_id", "id", "text_hash", "row")


def _before(key: tuple[int, ...], inclusive: bool) -> Column:
    """Rows whose key lies before ``key``."""
    own, limit = F.struct(*KEY), F.struct(*(F.lit(k).cast("long").alias(n) for n, k in zip(KEY, key)))
    return own <= limit if inclusive else own < limit


def medians(keys: DataFrame) -> DataFrame:
    """(*KEY, n): the lower median of every block of keys, and how many keys the block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            if sum(h.shape[1] for h in held) >= BLOCK:
                yield middle(held)
                held = []
        if sum(h.shape[1] for h in held):
            yield middle(held)

    def middle(held: list[np.ndarray]) -> pa.RecordBatch:
        block = np.concatenate(held, axis=1)
        n = block.shape[1]
        at = np.lexsort(block[::-1])[(n - 1) // 2]
        return pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in (*block[:, at], n)], [*KEY, "n"])

    return keys.select(*KEY).mapInArrow(run, ", ".join(f"{k} long" for k in (*KEY, "n")))


def weighted_median(rows: list[tuple[int, ...]]) -> tuple[int, ...]:
    """The first key, in order, with half of all weight at or before it; rows are (*key, weight)."""
    rows = sorted(rows)
    half, seen = sum(r[-1] for r in rows) / 2, 0
    for *key, n in rows:
        seen += n
        if seen >= half:
            return tuple(key)
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, small: int = SMALL) -> tuple[int, ...]:
    """The ``k``-th key of ``keys`` (written, all distinct), k from 1 to their number.

    A round keeps at most three quarters of the keys; one row per BLOCK keys or task
    reaches the driver, and at last no more than ``small`` keys.
    """
    left, n = keys, keys.count()
    while n > small:
        pivot = weighted_median([tuple(r) for r in medians(left).collect()])
        upto = left.where(_before(pivot, True)).count()
        if k <= upto:
            left, n = left.where(_before(pivot, True)), upto
        else:
            left, n, k = left.where(~_before(pivot, True)), n - upto, k - upto
        left = stage(left, "keys")
    return sorted(tuple(r) for r in left.select(*KEY).collect())[k - 1]


def numbered(winners: DataFrame) -> DataFrame:
    """(row, rank): rows in key order, numbered from 1 by a range sort and the sizes of its parts."""
    order = [F.col(c) for c in KEY]
    placed = stage(
        winners.repartitionByRange(*order).sortWithinPartitions(*order).select("row", F.monotonically_increasing_id().alias("at")), "ranks"
    )
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("part", before.alias("before")))  # one row a task of the sort
    return placed.select("row", part, place.alias("place")).join(offsets, "part").select("row", (F.col("before") + F.col("place") + 1).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    longest: int = LONGEST_GRAM, buckets: int = BUCKETS, small: int = SMALL,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per row of ``docs``.

    Of the N documents of ``least_words`` words or more, the floor of ``percent`` per cent
    with the highest scores are drawn and ranked from 1, equal scores by smaller doc_id;
    the others have a null rank.  Features of null and empty texts are none, their weight
    is 0; a target without any texts is a target of no features.  A null doc_id is hashed
    as the empty string and comes after all ids; rows with one doc_id and score come in
    order of their texts' hashes.  Repeated rows give repeated results and count in N
    each; no rows give no rows; other columns are not read.
    """
    gain = gains(docs, target, longest, buckets)
    scored = weigh(docs, gain, longest).withColumn("score", F.col("weight") + noise(seed))
    rows = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    keys = rows.where(F.col("n_words") >= least_words).select(
        (-F.col("score")).alias("neg"), F.col("doc_id").isNull().cast("long").alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.coalesce("text_hash", F.lit(0)).alias("text_hash"), "row",
    )
    k = keys.count() * percent // 100
    if k == 0:
        return rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    winners = keys.where(_before(cutoff(keys, k, small), True))
    drawn = numbered(winners)
    return rows.join(drawn.hint("merge"), "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
