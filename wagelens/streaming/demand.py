"""Demand over time: rows per key and window of event time, from a feed."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import LongType, StringType, StructType

from wagelens.streaming.feeds import ROCKSDB

#: what a row of the demand counts: a whole window, rows that came after its end was certain, rows without a time
CLOSED, LATE, UNTIMED = "closed", "late", "untimed"


def count_in_batches(feed: DataFrame) -> DataFrame:
    """Rows per (window, key) of each Arrow batch, with their number as the last column.

    Done where the rows are read, so a key or window with a third of all rows sends
    one row per batch and window to its state partition.
    """
    names = feed.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(names).aggregate([([], "count_all")])
            yield from counted.rename_columns([*names, "_n"]).to_batches()

    return feed.mapInArrow(count, StructType([*feed.schema.fields]).add("_n", LongType()))


class WindowCount(StatefulProcessor):
    """Holds one number per (window, key) until the watermark reaches the window's end."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n bigint")

    def out(self, key: tuple, n: int, status: str) -> Iterator[Row]:
        return iter((Row(**dict(zip(self.names, (*key, n, status)))),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        n = sum(r["_n"] for r in rows)
        end = key[1]
        if end is None:
            return self.out(key, n, UNTIMED)
        mark = timerValues.getCurrentWatermarkInMs()
        if 0 < mark and end <= mark:
            return self.out(key, n, LATE)
        if self.count.exists():
            n += self.count.get()[0]
        else:
            self.handle.registerTimer(end)
        self.count.update((n,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        n = self.count.get()[0]
        self.count.clear()
        return self.out(key, n, CLOSED)

    def close(self) -> None:
        pass


def windowed_demand(feed: DataFrame, keys: list[str], event_time: Column, width: str, delay: str, slide: str | None = None) -> DataFrame:
    """(window_start, window_end, keys, n, status): rows of a feed per key and window of event time.

    Windows are those of ``F.window(event_time, width, slide)``.  A window goes out once, as
    ``closed``, when the watermark (the latest time of the batches before, less ``delay``) has
    reached its end; state then forgets it, so it holds the keys of the open windows only.
    Rows that come in batches after that are given out as ``late`` with their window, those without a time as
    ``untimed`` without one.  So no row is lost: summed over ``status`` the result equals the
    batch ``groupBy(window, keys)`` of what has gone out, however the feed is cut into batches.

    ``keys`` are columns of numbers, texts or dates, under other names than those given
    here; a null is a key.  What the watermark has not reached stays in the state for
    the next start; ``feeds.close_feed`` gives it out.
    """
    clash = {"window_start", "window_end", "n", "status", "_start", "_end", "_n", "_at", "_window"} & set(keys)
    if clash:
        raise ValueError(f"keys with reserved names: {sorted(clash)}")
    feed.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    marked = feed.withColumn("_at", event_time.cast("timestamp")).select("_at", *keys).withWatermark("_at", delay)
    # F.window drops rows without a time, so those get a window of their own, taken off again
    placed = marked.withColumn("_window", F.window(F.coalesce("_at", F.timestamp_millis(F.lit(0))), width, slide or width))
    if slide is not None:  # such a row would be in every window around that time
        first = F.col("_window.start") == F.window(F.timestamp_millis(F.lit(0)), slide)["start"]
        placed = placed.where(F.col("_at").isNotNull() | first)

    def bound(side: str) -> Column:
        # a plain number is not judged by the engine, which would drop late rows unseen
        return F.when(F.col("_at").isNotNull(), F.unix_millis(F.col(f"_window.{side}")))

    rows = placed.select(bound("start").alias("_start"), bound("end").alias("_end"), *keys)
    out = StructType([*rows.schema.fields]).add("n", LongType()).add("status", StringType())
    found = count_in_batches(rows).groupBy("_start", "_end", *keys).transformWithState(WindowCount(out.names), out, "Append", "EventTime")
    return found.select(
        F.timestamp_millis("_start").alias("window_start"), F.timestamp_millis("_end").alias("window_end"), *keys, "n", "status"
    )


def demand_over_time(demand: DataFrame, keys: list[str]) -> DataFrame:
    """(window_start, window_end, keys, n): what has gone out so far, late rows added to their windows."""
    timed = demand.where(F.col("window_start").isNotNull())
    return timed.groupBy("window_start", "window_end", *keys).agg(F.sum("n").alias("n"))


def demand_trend(over_time: DataFrame, key: str) -> DataFrame:
    """Adds each key's share of its window, its number in the window before and the change in share.

    ``over_time`` holds one row per (window_start, window_end, key) of windows that do
    not overlap.  A key that a window lacks had 0 there; before the first window of all,
    and after a window without any row, ``n_before`` and ``share_change`` are null.
    The windows that are ordered hold one row per key and window, never postings.
    """
    totals = over_time.groupBy("window_start", "window_end").agg(F.sum("n").alias("_total"))
    width = F.unix_micros("window_end") - F.unix_micros("window_start")
    shared = over_time.join(totals, ["window_start", "window_end"]).withColumn("share", F.col("n") / F.col("_total"))
    order = Window.partitionBy(key).orderBy("window_start")
    follows = F.unix_micros("window_start") - F.unix_micros(F.lag("window_start").over(order)) == width
    before = totals.select(F.col("window_end").alias("window_start"), F.lit(True).alias("_known"))
    seen = shared.withColumns({
        "_n_before": F.when(follows, F.lag("n").over(order)), "_share_before": F.when(follows, F.lag("share").over(order)),
    }).join(before, "window_start", "left")
    known = F.col("_known").isNotNull()
    return seen.select(
        "window_start", "window_end", key, "n", "share",
        F.when(known, F.coalesce("_n_before", F.lit(0))).cast("bigint").alias("n_before"),
        F.when(known, F.col("share") - F.coalesce("_share_before", F.lit(0.0))).alias("share_change"),
    )


# tasks get these functions with the job, so workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
