"""Time-to-live per key on a stream: the first event of a key, then none until it expires."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadpulse.operators.suppression import TTL_SECONDS


def _distinct_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of a (key, second) inside an Arrow batch go before the shuffle, hot keys with them."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.group_by(table.column_names).aggregate([])
        yield from table.to_batches()


class _Fills(StatefulProcessor):
    """Holds a key's events until the watermark has passed them, then fills in order of time.

    State: the second of the last fill, while it lasts, and the seconds still waiting. One timer per
    key goes off at the first waiting second or, if none waits, when the last fill has expired.
    """

    def __init__(self, key: str, second: str, ttl: int) -> None:
        self.key, self.second, self.ttl = key, second, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("at", T.LongType())]))
        self.waiting = handle.getValueState(
            "waiting", T.StructType([T.StructField("seconds", T.ArrayType(T.LongType()))]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [np.asarray(self.waiting.get()[0], dtype="int64")] if self.waiting.exists() else []
        seconds = np.unique(np.concatenate([*held, *(frame[self.second].to_numpy("int64") for frame in rows)]))
        yield from self._settle(key, seconds, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seconds = np.asarray(self.waiting.get()[0], dtype="int64") if self.waiting.exists() else np.empty(0, "int64")
        yield from self._settle(key, seconds, timerValues.getCurrentWatermarkInMs())

    def _settle(self, key: tuple, seconds: np.ndarray, watermark: int) -> Iterator[pd.DataFrame]:
        due, later = np.split(seconds, [np.searchsorted(seconds * 1000, watermark, "right")])
        last = int(self.last.get()[0]) if self.last.exists() else None
        at, fills = 0 if last is None else int(np.searchsorted(due, last + self.ttl)), []
        while at < len(due):    # from fill to fill; the seconds between them are jumped over
            last = int(due[at])
            fills.append(last)
            at = int(np.searchsorted(due, last + self.ttl))
        expired = last is not None and (last + self.ttl) * 1000 <= watermark
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if last is None or expired:
            self.last.clear()
        else:
            self.last.update((last,))
        if len(later):
            self.waiting.update((later.tolist(),))
            self.handle.registerTimer(int(later[0]) * 1000)
        else:
            self.waiting.clear()
            if last is not None and not expired:
                self.handle.registerTimer((last + self.ttl) * 1000)
        if fills:
            yield pd.DataFrame({self.key: [key[0]] * len(fills), self.second: fills})


def fills_on_stream(
    events: DataFrame, key: str, second: str, ttl: int = TTL_SECONDS, delay: str = "0 seconds",
) -> DataFrame:
    """(key, second) of the events that fill, as `operators.suppression.fill_moments` finds them.

    Events may come up to `delay` behind the latest one seen and in any order: a key's events wait
    until the watermark has passed them and are then taken by time, so the fills equal those of the
    batch operator over all events that weren't late. Late ones, at or behind the watermark when
    they arrive, are left out; so are events without a second. A fill comes out once the watermark
    has passed it, at the latest with the next trigger after later events.

    State is bounded by what is live: a key's last fill is cleared by a timer `ttl` seconds after it,
    and each waiting second as the watermark passes. Keys are texts, seconds whole numbers. The
    session must keep its state in RocksDB (`spark.sql.streaming.stateStore.providerClass`).
    """
    schema = f"{key} string, {second} bigint"
    slim = events.filter(F.col(second).isNotNull()).select(key, second).mapInArrow(_distinct_in_batch, schema)
    timed = slim.withColumn("__at", F.timestamp_seconds(second)).withWatermark("__at", delay)
    return timed.groupBy(key).transformWithStateInPandas(
        _Fills(key, second, ttl), schema, "Append", "EventTime")
