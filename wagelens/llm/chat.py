"""Chat formatting after cumulative-snapshot collapse.

Logs often hold a conversation again after every turn.  A rolling hash of each
prefix of turns identifies such snapshots: a conversation whose whole hash is a
proper prefix of another is dropped by an anti-join, equal ones keep the smallest
id, and what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.staging import stage

NO_ROLE = "unknown"
START, END = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, h1, h2) without nulls in role and text; h1, h2 hash one turn."""
    role, text = F.coalesce("role", F.lit(NO_ROLE)), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.withColumns({"h1": F.xxhash64(F.lit(1), "role", "text"), "h2": F.xxhash64(F.lit(2), "role", "text")})


ORDER = ("turn", "role", "h1", "h2")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, p1, p2, last): rolling hashes after each turn.

    A turn's hash with its place, joined by exclusive or: one pass over a
    conversation, however long, and 128 bits.
    """
    per = Window.partitionBy("conv_id").orderBy(*ORDER)
    upto = per.rowsBetween(Window.unboundedPreceding, 0)
    # repeated rows of a turn lie together and count once
    fresh = ~F.coalesce(F.struct(*ORDER).eqNullSafe(F.lag(F.struct(*ORDER)).over(per)), F.lit(False))
    narrow = turns.select("conv_id", *ORDER).withColumn("fresh", fresh).where("fresh")
    placed = narrow.withColumn("place", F.row_number().over(per))
    rolled = placed.withColumns({
        "p1": F.bit_xor(F.xxhash64(F.lit(1), "place", "h1")).over(upto),
        "p2": F.bit_xor(F.xxhash64(F.lit(2), "place", "h2")).over(upto),
        "last": F.lead("place").over(per).isNull(),
    })
    return rolled.select("conv_id", "place", "p1", "p2", "last")


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that are no proper prefix, one of equal ones."""
    rolled = stage(prefixes(turns), "prefixes")
    key = ["place", "p1", "p2"]
    whole = rolled.where("last").groupBy(key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = rolled.where("not last").select(key).distinct()
    return whole.join(inner, key, "left_anti").select("conv_id", F.col("place").alias("n_turns"), "copies")


def _rendered(turns: Column) -> Column:
    def one(t: Column) -> Column:
        # control strings inside a turn must not end it
        role, text = (F.regexp_replace(t[c], r"<\|", "< |") for c in ("role", "text"))
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, text): every maximal conversation rendered; ``copies`` counts equal ones.

    Turns are in order of ``turn``, null first, ties by role and hash of the text.
    A null role is ``unknown``, null text is empty.  Rows without conv_id belong to no
    conversation; repeated rows of a turn count once; an empty table gives no rows;
    other columns are ignored.
    """
    turns = _turns(conversations)
    kept = stage(maximal(turns), "maximal")
    item = F.struct("turn", "role", "h1", "h2", "text")
    lines = turns.join(kept, "conv_id").groupBy("conv_id", "n_turns", "copies").agg(
        F.array_distinct(F.sort_array(F.collect_list(item))).alias("turns")
    )
    return lines.select("conv_id", F.col("n_turns").cast("int").alias("n_turns"), "copies", _rendered(F.col("turns")).alias("text"))
