"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, its
source's target over its size.  The whole part is given; the fractions are rounded
together: two documents pass words between them in a random direction, with
probabilities that keep each expectation, until one fraction is 0 or 1.  A source
so keeps its words to within one document.  Blocks of about FAN documents are
folded each in one task; what a block leaves unsettled, one document, goes up a
tree of blocks of FAN.  No task holds more than a block, however large a source is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.columns import free_names
from wagelens.llm.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
FAN = 64


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and tab to carriage return; null has 0."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), "[^w]", "")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, without gathering them in one task."""
    order = F.col("source").asc_nulls_last()
    spread = stage(
        sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()),
        "sources",
    ).withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    # one row per partition, not per source
    counts = spread.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spread.join(counts.select("part", before.alias("before")), "part").select(
        *sources.columns, (F.col("before") + F.col("at")).alias("rank")
    )


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(source, size, ...) with ``target``: shares by weight, none above ``most`` times its size.

    What a full source cannot take goes to the others by weight.  The driver sees
    two sums per step, never the sources.
    """
    ranked = _ranked(sources)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumns({"weight": weight, "cap": most * F.col("size")}), "weighted")
    wanted = share * (ranked.agg(F.sum("size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("cap") < level * F.col("weight")
        n, caps, rest = ranked.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == full or not rest:
            break
        full, level = n, (wanted - (caps or 0)) / rest
    return ranked.withColumn("target", F.least(F.col("cap"), level * F.col("weight"))).drop("rank", "weight", "cap")


#: what tells the units of a source apart
UNIT = ("doc_id", "size", "copy")


def _uniform(*parts: Column) -> Column:
    """The same number from 0 to 1 for the same parts in every run."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / float(1 << 53)


def _settle(level: int):
    """Fold step: the held document and the next one pass words until one of them is whole."""

    def step(acc: Column, e: Column) -> Column:
        h, done = acc["held"], acc["done"]
        h_room, h_has = (1 - h["frac"]) * h["words"], h["frac"] * h["words"]
        e_room, e_has = (1 - e["frac"]) * e["words"], e["frac"] * e["words"]
        up, down = F.least(h_room, e_has), F.least(h_has, e_room)
        draw = _uniform(F.lit(level), *(x[c] for x in (h, e) for c in UNIT))
        rises = draw * (up + down) < down
        h_ends = F.when(rises, h_room <= e_has).otherwise(h_has <= e_room)
        moved = F.when(rises, up).otherwise(-down)

        def with_frac(x: Column, frac: Column) -> Column:
            return F.struct(x["words"].alias("words"), *(x[c].alias(c) for c in UNIT), frac.alias("frac"))

        held = F.when(h_ends, with_frac(e, e["frac"] - moved / e["words"])).otherwise(
            with_frac(h, h["frac"] + moved / h["words"])
        )
        gone = F.when(h_ends, F.struct(*(h[c].alias(c) for c in UNIT), rises.cast("int").alias("extra"))).otherwise(
            F.struct(*(e[c].alias(c) for c in UNIT), (~rises).cast("int").alias("extra"))
        )
        return F.struct(held.alias("held"), F.concat(done, F.array(gone)).alias("done"))

    return step


ITEM = "struct<words:bigint,doc_id:bigint,size:bigint,copy:bigint,frac:double>"
DONE = "array<struct<doc_id:bigint,size:bigint,copy:bigint,extra:int>>"


def _fold(items: DataFrame, level: int) -> DataFrame:
    """(source, block, item) to one row per block: what is settled and what is not."""
    blocks = items.groupBy("source", "block").agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
    start = F.struct(F.get("items", F.lit(0)).cast(ITEM).alias("held"), F.array().cast(DONE).alias("done"))
    folded = F.aggregate(F.slice("items", 2, F.size("items")), start, _settle(level))
    return blocks.select("source", "block", folded.alias("f")).select("source", "block", "f.held", "f.done")


def _numbered(rows: DataFrame) -> DataFrame:
    """Staged rows (..., text_hash, at) with ``copy``: a hash of the text and the row's number among its repeats.

    Repeats are numbered within each written part, and from what the parts before hold, so no task has all of them.
    """
    gone = [F.col(c).isNull() for c in ("doc_id", "source")]
    same = rows.withColumns({"same": F.xxhash64("doc_id", "source", "size", "text_hash", *gone), "part": F.shiftright("at", 33)})
    counts = same.groupBy("same", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("same", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    here = F.row_number().over(Window.partitionBy("same", "part").orderBy("at"))
    number = F.col("before") + F.col("here")
    numbered = same.withColumn("here", here).join(before.hint("merge"), ["same", "part"])
    return numbered.select("doc_id", "source", "size", F.xxhash64("text_hash", number).alias("copy"), "at")


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, alike: bool = True,
    at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Decide how often the mix takes each document.

    Returns (rows, decisions): one row per row of ``docs`` (doc_id, source, size, copy),
    and per distinct (doc_id, source, size, copy) the columns source_size, target,
    copies, taken.  ``taken`` is copies times size, never above ``most`` sizes.

    Null text and text of white space has size 0 and 0 copies.  A null source is a
    source, ranked last; a null doc_id is an id.  With ``alike``, rows of
    equal doc_id, source and size are decided together, as one document of their joint
    words (copy 0), and a source can miss its target by all of them.  Without, each row
    is a document, so every source ends within one row of its target; of equal rows
    some are taken more often, and how many is the same in every run.  ``at`` then tells
    rows apart, if ``docs`` has such numbers, and is kept in the rows.  An empty table
    gives no rows.  Draws hash ids, sizes and copies, so reruns on any partitioning agree.
    """
    given = [F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size")]
    if alike:
        rows = stage(docs.select(*given, F.lit(0).cast("long").alias("copy")), "sizes")
        units = stage(rows.groupBy("doc_id", "source", "size", "copy").agg(F.count(F.lit(1)).alias("rows")), "units")
    else:
        number = F.monotonically_increasing_id() if at is None else at
        rows = stage(docs.select(*given, F.xxhash64("text").alias("text_hash"), number.alias("at")), "sizes")
        rows = stage(_numbered(rows), "numbered")
        units = rows.select("doc_id", "source", "size", "copy", F.lit(1).cast("long").alias("rows"))
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("size"), F.count(F.lit(1)).alias("units")
    )
    targets = stage(source_targets(sources, weights, share, most), "targets")
    widest = targets.agg(F.max("units")).first()[0] or 0

    t = targets.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target", "units")
    expected = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    parts = units.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("expected", expected)
    parts = parts.withColumns({"whole": F.floor("expected"), "frac": F.col("expected") - F.floor("expected")})

    width = math.ceil(widest / FAN)
    block = F.pmod(F.xxhash64(F.lit("block"), *UNIT), F.ceil(F.col("units") / FAN))
    item = F.struct((F.col("size") * F.col("rows")).alias("words"), *UNIT, "frac")
    open_ = parts.where("frac > 0").select("source", block.alias("block"), item.alias("item"))
    settled, level = [], 0
    while True:
        folded = stage(_fold(open_, level), "folded")
        settled.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        if width <= 1:
            break
        width, level = math.ceil(width / FAN), level + 1
        open_ = folded.select("source", F.floor(F.col("block") / FAN).alias("block"), F.col("held").alias("item"))
    last = _uniform(F.lit("last"), *(F.col("held")[c] for c in UNIT)) < F.col("held.frac")
    extras = folded.select("source", *(F.col("held")[c].alias(c) for c in UNIT), last.cast("int").alias("extra"))
    for more in settled:
        extras = extras.unionByName(more)

    e = extras.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), F.col("copy").alias("c"), "extra")
    same = (
        F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
        & (F.col("copy") == F.col("c"))
    )
    copies = (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long")
    decisions = parts.join(e, same, "left").select(
        "doc_id", "source", "size", "copy", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
    return rows, stage(decisions, "decisions")


def decided(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows (doc_id, source, size, copy, ...) with the decision for each."""
    d = decisions.select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"),
        F.col("copy").alias("_c"), "source_size", "target", "copies", "taken",
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
        & (F.col("copy") == F.col("_c"))
    )
    return rows.join(d, same).drop("_d", "_s", "_z", "_c")


def repeat_documents(docs: DataFrame, alike: bool = True, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as decided, with the columns of ``docs``, whatever they are called."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    at, n, i, d, s, z = free_names(docs, "at", "n", "i", "d", "s", "z")
    if alike:
        _, decisions = mix(docs, **options)
        taken = decisions.select(F.col("doc_id").alias(d), F.col("source").alias(s), F.col("size").alias(z), F.col("copies").alias(n))
        same = docs["doc_id"].eqNullSafe(F.col(d)) & docs["source"].eqNullSafe(F.col(s)) & (word_count(docs["text"]) == F.col(z))
        rows = docs.join(taken.where(F.col(n) > 0).hint("merge"), same)  # grows with the documents: never broadcast
    else:
        # written, so that a row keeps its number
        every = stage(docs.withColumn(at, F.monotonically_increasing_id()), "rows")
        rows, decisions = mix(every, alike=False, at=F.col(at), **options)
        taken = decided(rows, decisions).where("copies > 0").select(F.col("at").alias(at), F.col("copies").alias(n))
        rows = every.join(taken.hint("merge"), at)
    return rows.select(*columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias(i)).select(*columns)
