"""Keep the first copy of each key by its place in the corpus, not by arrival.

A stream may bring a later copy first.  One value per key is held as state: the
smallest order seen.  A copy with a smaller order replaces it and comes out as
a change, so the change table's smallest order per key is what a batch job
would keep, whatever the order of arrival.  A timer on the event time drops a
key's state once no copy came for ``window``, so the state holds the keys of one
window only; a copy that comes later than that is a new key.

Rows of one micro-batch pass through the key's task one by one; the state of a
key is two numbers, whatever the number of its copies.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_copy(keys: list[str], window_ms: int) -> StatefulProcessor:
    """A processor that holds the smallest order of a key and the end of its
    window.  (Its class is local, so it travels to the workers by value.)"""
    class FirstCopy(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.kept = handle.getValueState("kept", T.StructType([T.StructField("order", T.LongType()), T.StructField("until", T.LongType())]))

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            best, until = None, 0
            for row in rows:
                best = row["order"] if best is None else min(best, row["order"])
                until = max(until, row["time_ms"] + window_ms)
            old = self.kept.get() if self.kept.exists() else None
            if old is not None:
                until = max(until, old[1])
            order = best if old is None else min(best, old[0])
            if old is None or until > old[1]:
                if old is not None:
                    self.handle.deleteTimer(old[1])
                self.handle.registerTimer(until)
            if old is None or (order, until) != (old[0], old[1]):
                self.kept.update((order, until))
            if old is None:
                yield Row(**dict(zip(keys, key)), order=order, replaces=None)
            elif order < old[0]:
                yield Row(**dict(zip(keys, key)), order=order, replaces=old[0])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            self.kept.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FirstCopy()


def changes(stream: DataFrame, keys: list[str], order: str, event_time: str, window: str, window_ms: int) -> DataFrame:
    """``keys``, ``order`` of the copy that is first now, ``replaces`` (the
    order that was first before; NULL for a new key).  ``window`` is the
    watermark's delay as text and ``window_ms`` how long a key is remembered
    after its last copy."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream.select(*keys, F.col(order).cast("long").alias("order"), F.col(event_time).alias("event_time"), F.unix_millis(event_time).alias("time_ms"))
    schema = T.StructType([*(stream.schema[k] for k in keys), T.StructField("order", T.LongType()), T.StructField("replaces", T.LongType())])
    return rows.withWatermark("event_time", window).groupBy(*keys).transformWithState(
        statefulProcessor=first_copy(keys, window_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime")


def first_copies(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The first copy of each key, from the written changes."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.min("order").alias("order"))
