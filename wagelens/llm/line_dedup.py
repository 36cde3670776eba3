"""Repeated runs of lines, found by winnowing over line hashes.

A window begins at any line with words and ends with the first line that makes it
``least_words`` words or more.  The least line hash in a window is its fingerprint:
equal windows have equal fingerprints at equal places, so a run of that many words
that occurs twice is never missed, and most windows are ruled out by a fingerprint
that occurs once.  Windows with shared fingerprints are joined by content to their
first place in the corpus; matches on one diagonal become runs, which are extended
line by line both ways, and every later run is deleted.

All steps are DataFrame operations.  A passage common to many documents is joined
to one place, never to all the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.mixing import word_count
from wagelens.llm.columns import free_names
from wagelens.llm.staging import stage

LEAST_WORDS = 50
BLANKS = " \t\x0b\x0c\r"
KEY = ["doc_id", "text_hash"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hashed(text: Column) -> Column:
    """Lines with words: where they are, their words, two hashes without outer blanks."""

    def one(line: Column, at: Column) -> Column:
        bare = F.btrim(line, F.lit(BLANKS))
        return F.struct(
            at.alias("at"), word_count(line).alias("words"), F.xxhash64(bare).alias("h"), F.xxhash64(F.lit(2), bare).alias("g")
        )

    return F.filter(F.transform(_lines(text), one), lambda x: x["words"] > 0)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _windows(hashed: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, text_hash, start, size, a, b, least): each window's place, content and fingerprint.

    A line has a word or more, so a window has ``least_words`` lines at most.
    """
    start = F.struct(
        F.lit(0).cast("long").alias("words"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("a"),
        F.lit(0).cast("long").alias("b"), F.lit((1 << 63) - 1).alias("least"),
    )

    def grow(w: Column, line: Column) -> Column:
        more = F.struct(
            (w["words"] + line["words"]).alias("words"), (w["size"] + 1).alias("size"),
            F.xxhash64(w["a"], line["h"]).alias("a"), F.xxhash64(w["b"], line["g"]).alias("b"),
            F.least(w["least"], line["h"]).alias("least"),
        )
        return F.when(w["words"] < least_words, more).otherwise(w)

    def window(line: Column, i: Column) -> Column:
        w = F.aggregate(F.slice("lines", i + 1, least_words), start, grow)
        return F.struct(i.alias("start"), w.alias("w"))

    found = F.filter(F.transform("lines", window), lambda x: x["w"]["words"] >= least_words)
    rows = hashed.select(*KEY, F.explode(found).alias("f"))
    return rows.select(*KEY, "f.start", "f.w.size", "f.w.a", "f.w.b", "f.w.least")


def _islands(spans: DataFrame, by: list[str]) -> DataFrame:
    """Overlapping or touching spans [lo, hi) of a group become one."""
    order = Window.partitionBy(*by).orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("lo") > before).cast("int"), F.lit(1))
    number = F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = spans.withColumn("begins", begins).withColumn("island", number)
    return numbered.groupBy(*by, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def _matches(windows: DataFrame) -> DataFrame:
    """Windows that are elsewhere first: (doc_id, text_hash, lo, hi, src_id, src_hash, shift)."""
    place = F.struct(*KEY, "start")
    # the small sides are written, so that the joins are plain shuffles and a frequent key can be split
    shared = windows.groupBy("least").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("not one <=> other")
    candidates = stage(windows.join(stage(shared.select("least"), "shared"), "least", "left_semi"), "candidates")
    firsts = candidates.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("end")).where("not first <=> end")
    later = candidates.join(stage(firsts.drop("end"), "firsts"), ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return later.select(
        *KEY, F.col("start").alias("lo"), (F.col("start") + F.col("size")).alias("hi"),
        F.col("first.doc_id").alias("src_id"), F.col("first.text_hash").alias("src_hash"),
        (F.col("start") - F.col("first.start")).alias("shift"),
    )


def _agreeing(one: Column, other: Column) -> Column:
    """Number of equal lines from the beginning of both."""
    same = F.zip_with(one, other, lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False)))
    stop = F.array_position(same, F.lit(False))
    return F.when(stop > 0, stop - 1).otherwise(F.size(same)).cast("int")


def _extended(runs: DataFrame, hashed: DataFrame, least_words: int) -> DataFrame:
    """Runs with the lines before and after that agree as well, as places among all lines.

    Fewer than ``least_words`` words can be missing at an end: with more, one more window
    would match, here or at a place that is earlier still.
    """
    own = hashed.withColumnRenamed("lines", "x")
    src = hashed.select(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash"), F.col("lines").alias("y"))
    both = runs.join(own.withColumnsRenamed({"doc_id": "o_id", "text_hash": "o_hash"}),
                     F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_hash") == F.col("o_hash")))
    both = both.join(src, F.col("src_id").eqNullSafe(F.col("s_id")) & (F.col("src_hash") == F.col("s_hash")))

    def before(lines: str, end: Column) -> Column:
        n = F.least(end, F.lit(least_words))
        return F.reverse(F.slice(lines, end - n + 1, n))

    src_lo, src_hi = F.col("lo") - F.col("shift"), F.col("hi") - F.col("shift")
    back = _agreeing(before("x", F.col("lo")), before("y", src_lo))
    on = _agreeing(F.slice("x", F.col("hi") + 1, least_words), F.slice("y", src_hi + 1, least_words))
    # a first occurrence in the same document stays whole: what overlaps it is not extended but cut
    itself = F.col("doc_id").eqNullSafe(F.col("src_id")) & (F.col("text_hash") == F.col("src_hash"))
    overlaps = itself & (F.col("lo") < src_hi)
    lo = F.when(overlaps, src_hi).when(itself, F.greatest(F.col("lo") - back, src_hi + on)).otherwise(F.col("lo") - back)
    hi = F.when(overlaps, F.col("hi")).otherwise(F.col("hi") + on)
    grown = both.withColumns({"lo": lo, "hi": hi}).where("lo < hi")
    return grown.select(
        *KEY, F.get("x", F.col("lo"))["at"].alias("lo"), (F.get("x", F.col("hi") - 1)["at"] + 1).alias("hi")
    )


def repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, text_hash, runs): the spans [lo, hi) of lines to delete, for documents that have any.

    Documents are ordered by doc_id, null first, then by the hash of the text; rows
    with the same of both are one document.
    """
    every = _keyed(docs.select("doc_id", "text")).where("text is not null")
    hashed = every.select(*KEY, _hashed(F.col("text")).alias("lines")).where("size(lines) > 0")
    hashed = stage(hashed.dropDuplicates(KEY), "lines")
    windows = stage(_windows(hashed, least_words), "windows")
    runs = stage(_islands(_matches(windows), [*KEY, "src_id", "src_hash", "shift"]), "runs")
    spans = _islands(_extended(runs, hashed, least_words), KEY)
    return stage(spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs")), "spans")


def _joined(docs: DataFrame, runs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a further column, null where nothing is deleted, and the name of that column.

    The runs grow with the documents, so this is a shuffled join at any size.
    """
    id_, hash_, runs_ = free_names(docs, "id", "hash", "runs")
    r = runs.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("runs").alias(runs_))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_))
    return docs.join(r.hint("merge"), same, "left").drop(id_, hash_), runs_


def _kept(text: Column, runs: Column) -> Column:
    """The text without the lines of ``runs``: the stretches between them, joined."""
    ends = F.concat(F.array(F.lit(0)), runs["hi"])
    begins = F.concat(runs["lo"], F.array(F.size(_lines(text))))
    stretches = F.zip_with(ends, begins, lambda a, b: F.slice(_lines(text), a + 1, b - a))
    return F.when(runs.isNull(), text).otherwise(F.array_join(F.flatten(stretches), "\n"))


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs``, with its columns, without later repeats of runs of ``least_words`` words or more.

    Lines are compared without blanks at their ends; lines without words neither
    break nor make a run and go only with what surrounds them.  A text all of whose
    lines repeat becomes empty; null text stays null; no row is dropped.  Rows with
    equal doc_id and text are one document, cleaned alike; an empty table gives no rows.
    Further columns keep their names and values, whatever they are called.
    """
    joined, runs = _joined(docs, repeated_runs(docs, least_words))
    return joined.select(*(_kept(F.col(c), F.col(runs)).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def removed_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed, text_sha256), one row per row of ``docs``.

    ``removed`` lists spans of lines as lo:hi, joined by commas; the hash is of the
    text that stays, null for null text.
    """
    rows, found = _joined(docs.select("doc_id", "text"), repeated_runs(docs, least_words))
    runs = F.coalesce(F.col(found), F.array().cast("array<struct<lo:int,hi:int>>"))
    n_lines = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0))
    removed = F.aggregate(runs, F.lit(0), lambda n, r: n + r["hi"] - r["lo"])
    spans = F.array_join(F.transform(runs, lambda r: F.concat_ws(":", r["lo"].cast("string"), r["hi"].cast("string"))), ",")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").isNull(), 0).otherwise(n_lines).alias("n_lines"),
        removed.alias("n_removed"), spans.alias("removed"), F.sha2(_kept(F.col("text"), F.col(found)), 256).alias("text_sha256"),
    )
