"""Numbers for the nodes of a trie over a vocabulary of any size.

The vocabulary is cut into ranges of words at split strings drawn from a bounded
sample.  A node lies inside one range unless its prefix begins a split string, so
only prefixes of split strings are numbered on the driver; all others are numbered
where their range is, from the sorted words, by the prefix a word shares with the
one before it.  No prefix is ever written out: a word costs one number a letter,
also where it has a million of them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.session import ship_package

#: words of a range, most ranges, sampled words a range, code points of a split string
RANGE_WORDS, MOST_RANGES, DRAWN, SPLIT_LENGTH = 50_000, 4096, 16, 64
ROOT = 0


def shared_length(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def split_strings(words: DataFrame, word: Column, n: int) -> list[str]:
    """Sorted strings that cut ``n`` words into ranges of about RANGE_WORDS, or MOST_RANGES ranges."""
    ranges = min(MOST_RANGES, n // RANGE_WORDS + 1)
    if ranges == 1:
        return []
    every = max(1, n // (ranges * DRAWN))
    drawn = words.select(word.alias("w")).where(F.pmod(F.xxhash64("w"), F.lit(every)) == 0)
    drawn = sorted(r.w for r in drawn.select(F.substring("w", 1, SPLIT_LENGTH).alias("w")).collect())
    return sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)} - {""}) if drawn else []


def edge_nodes(splits: list[str]) -> list[list[int]]:
    """Nodes of the prefixes of each split string, by length; below ROOT, so that they differ from all others."""
    nodes, fresh, before = [], -1, ""
    for split in splits:
        shared = shared_length(before, split)
        own = nodes[-1][: shared + 1] if nodes else [ROOT]
        more = len(split) - len(own) + 1
        nodes.append(own + list(range(fresh, fresh - more, -1)))
        fresh, before = fresh - more, split
    return nodes


class Numbering:
    """Nodes of words that come sorted, range by range."""

    def __init__(self, splits: list[str]):
        self.splits, self.edges = splits, edge_nodes(splits)
        self.range, self.fresh, self.word, self.stack = None, 0, "", [ROOT]

    def range_of(self, word: str) -> int:
        return bisect_right(self.splits, word)

    def nodes(self, at: int, word: str) -> list[int]:
        """Nodes of all prefixes of the word, from the empty one to the word itself."""
        if at != self.range:
            self.range, self.fresh, self.word, self.stack = at, (at + 1) << 33, "", [ROOT]
        own = [ROOT]
        for k in (at - 1, at):  # the split strings below and above are the closest ones
            if 0 <= k < len(self.splits):
                edge = self.edges[k][: shared_length(self.splits[k], word) + 1]
                own = max(own, edge, key=len)
        own = own + self.stack[len(own) : shared_length(self.word, word) + 1]
        more = len(word) + 1 - len(own)
        self.stack, self.word = own + list(range(self.fresh, self.fresh + more)), word
        self.fresh += more
        return self.stack


def number_nodes(words: DataFrame, n: int, reverse: bool = False) -> DataFrame:
    """(id, nodes): for ``n`` distinct words (id, word), the trie nodes of all prefixes, the empty one first.

    With ``reverse`` the nodes are those of the reversed words, so of suffixes.  Equal
    nodes are equal prefixes, whichever words they come from.
    """
    word = F.reverse("word") if reverse else F.col("word")
    splits = split_strings(words, word, n)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = Numbering(splits)
        for batch in batches:
            ranges = [numbering.range_of(w) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ranges, pa.int32())], ["id", "word", "range"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = Numbering(splits)
        for batch in batches:
            ends, flat = [0], []
            for at, word in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                flat.append(np.array(numbering.nodes(at, word), np.int64))
                ends.append(ends[-1] + len(word) + 1)
            nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat or [np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), nodes], ["id", "nodes"])

    ship_package(words.sparkSession)
    placed = words.select("id", word.alias("word")).mapInArrow(place, "id long, word string, range int")
    return placed.repartition("range").sortWithinPartitions("range", "word").mapInArrow(number, "id long, nodes array<long>")
