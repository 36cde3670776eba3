"""Spelling variants by a dictionary of pairs of trie nodes.

Every prefix of the vocabulary is a node of a trie, every suffix a node of the trie of
reversed words (``tries``).  A word leaves the pair (prefix, suffix) around each of its
positions, with that position skipped, and around each gap between positions, with
nothing skipped.  Two words differ by one replaced code point if they share a pair with
a position skipped in both, and by one inserted or deleted code point if a skipping pair
of the longer is a gap of the shorter.  Pairs are two integers, so the join is exact and
needs no check of the words.

Words that meet under one pair are never listed against each other: each needs how many
there are and the first of the others by rank, which a window over the pair gives.
Words are ranked by falling count, then by code point, so "the best" is a least integer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.staging import stage
from wagelens.llm.tries import number_nodes
from wagelens.session import ship_package

#: every so many runs, by hash, loses a code point
DROP_EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: a form occurs at least so many times as often as its variant
FORM_FACTOR = 2
#: distinct words a task counts before it sends them on
HELD_WORDS = 1 << 18
#: code points of a text searched at once
PIECE = 1 << 20

_RUN = re.compile("[a-zÀ-ÿ]+")
#: what a pair skips: nothing, a position, or a position that begins a run of equal code points
GAP, SKIP, SKIP_FIRST = 2, 1, 0


def runs_of(text: str) -> Counter[str]:
    """Maximal runs of letters up to U+00FF with A-Z in lower case, and how often each occurs."""
    low = text.encode("utf-8", "replace").lower().decode()  # bytes: exactly A-Z
    if len(low) <= PIECE:
        return Counter(_RUN.findall(low))
    found: Counter[str] = Counter()
    for m in _RUN.finditer(low):  # one at a time: the list of all would be many times the text
        found[m.group()] += 1
    return found


def count_words(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, drop_every: int | None = DROP_EVERY
) -> DataFrame:
    """(word, n): distinct words of ``least_length`` code points, ``least_count`` times or more in all texts.

    A run whose hash with its doc_id is a multiple of ``drop_every`` loses one code point
    (None: no run does).  Null texts have no words, a null doc_id hashes as the empty
    string, repeated rows count repeatedly, other columns are not read.  Each task adds up
    before it sends, so a word with a third of all occurrences is a few rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id = doc_id.as_py()
                start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
                for word, n in runs_of(text.as_py() or "").items():
                    if drop_every is not None and (h := zlib.crc32(word.encode(), start)) % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield counted(held)
                    held.clear()
        yield counted(held)

    def counted(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def ranked(words: DataFrame) -> DataFrame:
    """(id, word, n), written; ids rise with falling n, then in code-point order of the words."""
    order = [F.desc("n"), F.asc("word")]
    rows = words.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(rows.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def pairs(words: DataFrame, n: int) -> DataFrame:
    """(p, s, id, tag): the pairs of trie nodes of every word; ``tag`` is what the pair skips."""
    forward, backward = number_nodes(words, n), number_nodes(words, n, reverse=True)
    nodes = (
        words.select("id", "word").join(forward.withColumnRenamed("nodes", "pre"), "id")
        .join(backward.withColumnRenamed("nodes", "suf"), "id")
        .withColumn("length", F.length("word"))
        .withColumn("letters", F.split("word", ""))
        .withColumn(
            "tags",
            F.expr(f"transform(slice(letters, 1, length), (c, i) -> if(i > 0 and c = letters[i - 1], {SKIP}, {SKIP_FIRST}))"),
        )
    )
    skipped = "arrays_zip(slice(pre, 1, length), reverse(slice(suf, 1, length)), tags)"
    gaps = f"arrays_zip(pre, reverse(suf), array_repeat({GAP}, length + 1))"
    row = "array<struct<p:bigint,s:bigint,tag:int>>"
    return nodes.selectExpr("id", f"inline(concat(CAST({skipped} AS {row}), CAST({gaps} AS {row})))").select("p", "s", "id", "tag")


def neighbours(words: DataFrame, n: int) -> DataFrame:
    """(id, n_near, best): how many words are one edit away, and the first of them by rank; words without any are left out."""
    in_order = Window.partitionBy("p", "s").orderBy(F.col("tag") == GAP, "id")
    met = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one sort serves both
    skips, gap = F.col("tag") != GAP, F.col("tag") == GAP
    first = F.min(F.when(skips, F.col("id"))).over(met)
    found = pairs(words, n).select(
        "id",
        "tag",
        first.alias("first"),
        F.when(skips & (F.lead("tag").over(in_order) != GAP), F.lead("id").over(in_order)).alias("next"),
        F.sum(skips.cast("long")).over(met).alias("skips"),
        F.sum((F.col("tag") == SKIP_FIRST).cast("long")).over(met).alias("longer"),
        F.min(F.when(F.col("tag") == SKIP_FIRST, F.col("id"))).over(met).alias("first_longer"),
        F.max(F.when(gap, F.col("id"))).over(met).alias("shorter"),  # one word at most: a gap pair spells it
    )
    other = F.when(F.col("id") == F.col("first"), F.col("next")).otherwise(F.col("first"))
    shorter = F.when(F.col("tag") == SKIP_FIRST, F.col("shorter"))
    near = found.select(
        "id",
        F.when(gap, F.col("longer")).otherwise(F.col("skips") - 1 + shorter.isNotNull().cast("long")).alias("near"),
        F.when(gap, F.col("first_longer")).otherwise(F.least(other, shorter)).alias("best"),
    ).where("near > 0")
    return near.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def chain_ends(links: DataFrame) -> DataFrame:
    """(id, to) with at most one row an id and no cycles, to (id, to) with the last of each chain.

    Every round doubles the steps, so rounds are logarithmic in the longest chain.
    """
    ends = stage(links, "links")
    while True:
        ahead = ends.select(F.col("id").alias("to"), F.col("to").alias("end"))
        further = stage(ends.join(ahead, "to", "left").select("id", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")), "links")
        if further.where("moved").isEmpty():
            return ends
        ends = further.select("id", "to")


def group_variants(words: DataFrame, form_factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per distinct word of ``words`` (word, n).

    Words are near if one inserted, deleted or replaced code point turns one into the
    other.  ``form`` is the near word of largest n, of equal ones the first in code-point
    order, if its n is ``form_factor`` times the word's or more, else null; ``root`` the
    last word on the way from form to form.  ``form_factor`` is 2 at least, so a form
    occurs more often than its variant and the way ends.

    Rows of one word are added up; null words go; the empty word is a word; null n counts
    0 and such a word has no form (nor has any word of n below 1).  No rows give no rows;
    other columns are not read.
    """
    if form_factor < 2:
        raise ValueError("form_factor is 2 at least")
    distinct = words.where("word is not null").groupBy(F.col("word").cast("string").alias("word"))
    vocabulary = ranked(distinct.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0)).alias("n")))
    near = neighbours(vocabulary, vocabulary.count())
    other = vocabulary.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    # every word has one row on the right of a join, so a form of very many variants can be split
    rows = vocabulary.join(near, "id", "left").join(other.hint("merge"), "best", "left")
    often = (F.col("form_n") >= form_factor * F.col("n")) & (F.col("n") > 0)
    rows = stage(
        rows.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            *(F.when(often, F.col(c)).alias(c) for c in ("form", "form_n")), F.when(often, F.col("best")).alias("to"),
        ),
        "forms",
    )
    ends = chain_ends(rows.where("to is not null").select("id", "to"))
    last = vocabulary.select(F.col("id").alias("to"), F.col("word").alias("root"))
    roots = ends.join(last.hint("merge"), "to").select("id", "root")
    found = rows.drop("to").join(roots, "id", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
