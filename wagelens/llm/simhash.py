"""SimHash near-duplicates by pigeonhole blocks.

Distinct fingerprints are cut into blocks of bits.  Of ``b`` blocks, two
fingerprints at most ``d`` bits apart share ``b - d`` at least, so equal values
under one choice of ``b - d`` blocks find every close pair.  The number of blocks
grows with the number of fingerprints, so a bucket holds few strangers at any size;
a bucket that is large all the same is cut by further blocks.
Rows are sorted by bucket; a task compares within buckets in numpy, verifies the
distance, and emits only a spanning forest of what it linked, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.columns import free_names
from wagelens.llm.components import connected_components
from wagelens.llm.forest import spanning_forest
from wagelens.llm.staging import stage
from wagelens.session import ship_package

BITS = 64
SEED = 42
#: shingles counted at once: 4 MB of bits
PIECE = 1 << 16
#: buckets up to this size are compared pair by pair in vectors, larger ones by search from node to node
SMALL = 48
#: fingerprints a bucket of one task should have at most; share of them that is counted to tell; masks of a cut
BUCKET, SAMPLE, MOST_CUTS = 1 << 16, 64, 330


def fingerprint(text: bytes | None, shingle_words: int) -> int:
    """Majority bits of the XXH64 of all shingles; 0 without words."""
    words = (text or b"").lower().split()  # bytes: exactly A-Z, and exactly \\x20 and \\x09-\\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle_words, len(words)) - 1 :].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        pairs = zip(starts[at : at + PIECE], ends[at : at + PIECE])
        hashes = np.array([digest(line[i:j], SEED) for i, j in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, text_hash, fp): one row per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])

    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def block_masks(n: int, distance: int, fixed: int = 0, most: int | None = None) -> list[int]:
    """Masks of bits such that two of ``n`` fingerprints within ``distance`` agree under one of them.

    As few blocks as leave about a quarter of a chance mate in a bucket, or less, within
    ``most`` masks.  Bits of ``fixed``, in which the fingerprints agree, are in every mask; the others
    are cut.  None if there are too few of those to cut.
    """
    free = [i for i in range(BITS) if not fixed >> i & 1]
    blocks = distance + 1
    if len(free) < blocks:
        return []
    while blocks < len(free) and n > 0.25 * 2 ** ((blocks - distance) * (len(free) // blocks)) and (most is None or comb(blocks + 1, distance) <= most):
        blocks += 1
    edges = np.linspace(0, len(free), blocks + 1).round().astype(int).tolist()
    parts = [sum(1 << x for x in free[i:j]) for i, j in zip(edges, edges[1:])]
    return [fixed | sum(c) for c in combinations(parts, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> BITS - 1 else mask


def buckets(distinct: DataFrame, n: int, masks: list[int], distance: int) -> DataFrame:
    """(mask, bucket, fp): each of ``n`` fingerprints under every mask, with buckets of about BUCKET at most.

    A larger bucket is cut again by blocks of the bits its mask leaves open: what is within
    ``distance`` agrees under one of those.  Large ones are found by counting the
    fingerprints of one hash in SAMPLE; to miss one would cost time, not links.
    """
    rows = distinct.select("fp", F.explode(F.array(*(F.lit(_signed(m)).cast("long") for m in masks))).alias("mask"))
    rows = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"), "fp")
    if n <= BUCKET:  # no bucket holds more
        return rows
    done = []
    while True:
        drawn = rows.where(F.pmod(F.xxhash64(F.lit("size"), "fp"), F.lit(SAMPLE)) == 0)
        sizes = drawn.groupBy("mask", "bucket").agg((F.count(F.lit(1)) * SAMPLE).alias("n")).where(F.col("n") > BUCKET)
        large = stage(sizes, "large")
        widest = large.groupBy("mask").agg(F.max("n").alias("n")).collect()  # at most a row a mask
        cuts = [(r["mask"], _signed(m)) for r in widest for m in block_masks(r["n"], distance, r["mask"] % (1 << BITS), MOST_CUTS)]
        if not cuts:
            break
        able = large.where(F.col("mask").isin(sorted({m for m, _ in cuts}))).select("mask", "bucket")
        done.append(rows.join(able, ["mask", "bucket"], "left_anti"))
        finer = F.broadcast(distinct.sparkSession.createDataFrame(cuts, "mask long, finer long"))
        cut = rows.join(able, ["mask", "bucket"], "left_semi").join(finer, "mask")
        rows = stage(cut.select(F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("bucket"), "fp").distinct(), "cut")
    return reduce(DataFrame.unionByName, [*done, rows])


def close_within(fps: np.ndarray, first: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of links that span all pairs within ``distance`` inside each bucket.

    ``fps`` lie bucket by bucket, ``first`` has where buckets begin.
    """
    sizes = np.diff(np.append(first, len(fps)))
    small = np.repeat(sizes <= SMALL, sizes)
    left = np.repeat(first + sizes, sizes) - np.arange(len(fps))  # rows from here to the bucket's end
    a, b = [], []
    at = np.flatnonzero(small & (left > 1))
    step = 1
    while len(at):
        hit = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= distance]
        a.append(fps[hit])
        b.append(fps[hit + step])
        step += 1
        at = at[left[at] > step]
    for i, n in zip(first[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        apart = fps[i : i + n]  # not reached yet; each search step takes out what it reaches
        while len(apart):
            reached, apart = [apart[0]], apart[1:]
            while reached and len(apart):
                x = reached.pop()
                near = np.bitwise_count(apart ^ x) <= distance
                if near.any():
                    y = apart[near]
                    a.append(np.full(len(y), x))
                    b.append(y)
                    reached.extend(y)
                    apart = apart[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def near_links(distinct: DataFrame, n: int, distance: int) -> DataFrame:
    """(a, b): links that connect whatever of ``n`` distinct fingerprints are within ``distance``, in few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]

        def linked(mask: np.ndarray, bucket: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.append(True, (mask[1:] != mask[:-1]) | (bucket[1:] != bucket[:-1])))
            a, b = spanning_forest(*close_within(fps, first, distance))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new[2] = new[2].view(np.uint64)
            if not len(new[0]):
                continue
            # a bucket may go on in the next batch: hold back the last one
            last = (new[0] == new[0][-1]) & (new[1] == new[1][-1])
            cut = len(last) - int(last.sum())
            if cut == 0 and len(held[0]) and (held[0][-1], held[1][-1]) == (new[0][0], new[1][0]):
                held = [np.concatenate(x) for x in zip(held, new)]
                continue
            whole = [np.concatenate((h, x[:cut])) for h, x in zip(held, new)]
            if len(whole[0]):
                yield linked(*whole)
            held = [x[cut:] for x in new]
        if len(held[0]):
            yield linked(*held)

    spread = buckets(distinct, n, block_masks(n, distance), distance).repartition("mask", "bucket").sortWithinPartitions("mask", "bucket")
    return spread.mapInArrow(run, "a long, b long")


def _named(docs: DataFrame, shingle_words: int, distance: int) -> DataFrame:
    """(doc_id, text_hash, fp, name): each row with the least row of its component.

    ``name`` is (no_id, doc_id, text_hash), so rows with an id come before rows without.
    """
    prints = stage(fingerprints(docs, shingle_words), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = stage(prints.groupBy("fp").agg(F.min(place).alias("first")), "distinct")
    links = near_links(distinct.select("fp"), distinct.count(), distance)
    roots = connected_components(links)
    members = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    # written, so that the join below is a plain shuffle and a large component can be split
    names = stage(members.groupBy("root").agg(F.min("first").alias("name")), "names")
    return prints.join(members.join(names, "root").select("fp", "name"), "fp")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Fingerprints link when they differ in ``distance`` bits or fewer; the component
    has all that links reach, under its smallest doc_id.  Null and empty texts have
    fingerprint 0 and link like any other.  A null doc_id keeps its row and its
    links but never names a component (its id is null if all ids are).  Repeated
    rows give repeated results; an empty table none; other columns are ignored.
    """
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _named(docs, shingle_words, distance).select("doc_id", digits.alias("fingerprint"), F.col("name.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    It is the row of least doc_id, null last, and of several texts under that id the
    one of least hash; of rows with equal id and text one stays.  Further columns keep
    their names and values, whatever they are called.
    """
    own = F.col("doc_id").eqNullSafe(F.col("name.doc_id")) & (F.col("text_hash") == F.col("name.text_hash"))
    found = _named(docs, shingle_words, distance).where(own)
    keep = stage(found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")), "kept")
    id_, hash_ = free_names(docs, "id", "hash")
    ids = keep.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).hint("merge")  # grows with the documents: never broadcast
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_))
    kept = docs.join(ids, same, "left_semi")
    if keep.where("rows > 1").isEmpty():
        return kept
    return kept.withColumn(hash_, F.xxhash64("text")).dropDuplicates(["doc_id", hash_]).drop(hash_)
