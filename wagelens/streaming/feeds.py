"""The posting feed as streams over files."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import StructType

#: keeps state on the executors' disks and can hold timers
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_feed(spark: SparkSession, path: str, schema: StructType, name: str = "*", per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder, as they arrive."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)


def append_feed(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to a parquet table, then stop.

    The checkpoint makes each input file count once, also after a restart;
    both paths belong in storage the whole cluster sees.
    """
    return (
        feed.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def thin_repeats(feed: DataFrame, key: str, time: str, seq: list[str], grain: str) -> DataFrame:
    """Keep the first row, by (time, seq), of each key and grain of time per Arrow batch.

    Done where the rows are read, so a key with a third of all rows sends a few
    rows to its state partition instead of all.  Lateness is judged by the grain,
    so the rows left out would be late together with the one that stays.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pc.sort_indices(batch, sort_keys=[(c, "ascending") for c in (key, grain, time, *seq)], null_placement="at_start")
            codes = [pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy() for c in (key, grain)]
            codes = np.stack([c[order.to_numpy()] for c in codes])
            first = np.append(True, (codes[:, 1:] != codes[:, :-1]).any(axis=0))[: batch.num_rows]
            yield batch.take(order.filter(pa.array(first)))

    return feed.mapInArrow(thin, feed.schema)


class FirstSeen(StatefulProcessor):
    """Holds one row per key: the first by (time, seq) that has come and was not late.

    It goes out when the watermark reaches its grain of time, since whatever comes
    then and lies before it is late.  The key is held on, to drop repeats, until
    the watermark is ``horizon`` beyond that.
    """

    def __init__(self, schema: StructType, order: list[str], grain: str, horizon: timedelta | None):
        self.schema, self.names, self.order, self.grain, self.horizon = schema, schema.names, order, grain, horizon  # grain in milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", self.schema)
        self.sent = handle.getValueState("sent", "sent boolean")

    def place(self, row: tuple) -> list[tuple]:
        """Sort key of a row; a null comes before all values."""
        values = (row[self.names.index(c)] for c in self.order)
        return [(v is not None, v) for v in values]

    def at(self, row: tuple) -> int:
        return row[self.names.index(self.grain)]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        new = min(map(tuple, rows), key=self.place, default=None)
        if new is None or self.sent.exists():
            return iter(())
        held = self.row.get() if self.row.exists() else None
        if held is None or self.place(new) < self.place(held):
            if held is not None:
                self.handle.deleteTimer(self.at(held))
            self.row.update(new)
            self.handle.registerTimer(self.at(new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if self.sent.exists():
            self.sent.clear()
            return iter(())
        row = tuple(self.row.get())
        self.row.clear()
        self.sent.update((True,))
        if self.horizon is not None:
            self.handle.registerTimer(self.at(row) + int(self.horizon.total_seconds() * 1000))
        return iter((Row(**dict(zip(self.names, row))),))

    def close(self) -> None:
        pass


def first_seen_feed(
    feed: DataFrame, key: str, event_time: Column, delay: str, seq: tuple[str, ...] = (), horizon: timedelta | None = None,
    grain: str = "second",
) -> DataFrame:
    """The first row of every key by event time, whatever the order of arrival.

    ``seq`` names columns of numbers or texts that decide between equal times.  Rows may come up to
    ``delay`` (an interval, as in "2 hours") behind the latest one read; those that
    come later are late and not counted, which the query's progress reports.  A key's
    row goes out once the watermark has reached it, so nothing that still counts can
    come before it: the result does not depend on how the feed is cut into batches.

    With a ``horizon`` a key is forgotten when the watermark is so far beyond its row,
    so state holds the keys of that span; until then its rows are repeats.  Without,
    keys are held for good, as a run-wide set of seen ids is.  Lateness is judged by
    ``grain`` (a unit of ``date_trunc``).  Rows without a time have no place in the order
    and are left out; a null key is a key.  What the watermark has not reached when the
    feed ends stays in the state, for the next start: ``close_feed`` gives the rows out.
    """
    spark = feed.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    time = event_time.cast("timestamp")
    timed = feed.withColumns({"_time": F.unix_micros(time), "_grain": F.date_trunc(grain, time)}).where("_time IS NOT NULL")
    timed = timed.withColumn("_timer", F.unix_millis("_grain"))
    thinned = thin_repeats(timed, key, "_time", list(seq), "_grain").withWatermark("_grain", delay)
    processor = FirstSeen(timed.schema, ["_time", *seq], "_timer", horizon)
    found = thinned.groupBy(key).transformWithState(processor, timed.schema, "Append", "EventTime")
    return found.drop("_time", "_grain", "_timer")


def close_feed(spark: SparkSession, path: str, schema: StructType, values: dict[str, object]) -> None:
    """Add a last row with the given values, others null, to a folder of parquet files.

    With a time beyond ``delay`` after all rows it lets the watermark pass them.  Its own
    key stays in the state.
    """
    row = [tuple(values.get(c) for c in schema.names)]
    spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(path)


# tasks get these functions with the job, so workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
