"""Streaming "sensor stays hot too long" matching (V1, V2, V3).

Every micro-batch runs the batch operator of :mod:`riverbend.operators.patterns`
over the readings that the event-time watermark has passed, after what is
carried from the batches before: one small row per device with an open match (or,
for V3, whose last reading is cool), readings that still wait for the watermark,
and the watermark.  So a device is split over tasks as in batch, there is no
Python in the job, and matches go on over the borders of batches.  The
carry is a table under ``state_path`` per batch id: a replayed batch reads the
same carry and finds the same matches (``write`` must be idempotent per batch id).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.operators.patterns import match_greedy, match_runs
from riverbend.streaming.eventtime import EventTimeBuffer


class HotMatcher:
    """Matches of one version over micro-batches, in order of their ids.

    A reading waits until a reading at least ``delay_seconds`` later has been
    seen; one behind the watermark on arrival is dropped, and NULL and NaN
    readings are none, as in batch.  Readings at one time are ordered by ``tiebreak``.
    """

    def __init__(self, key: str, ts: str, temp: str, tiebreak: str, threshold: float, tolerance_seconds: float,
                 version: int, state_path: str, delay_seconds: float = 0.0):
        self.names, self.rule = (key, ts, temp, tiebreak), (threshold, tolerance_seconds)
        self.version, self.where = version, (ts, state_path, delay_seconds)
        self.buffer: EventTimeBuffer | None = None

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Closing readings (input columns) of the matches that end in this batch."""
        key, _, temp, _ = self.names
        if self.buffer is None:
            ts, path, delay = self.where
            self.buffer = EventTimeBuffer(ts, path, T.StructType([batch.schema[key], T.StructField("us", T.LongType()),
                                                                  T.StructField("cool", T.BooleanType())]), delay)
        due, waiting, carried = self.buffer.take(batch, batch_id, F.col(temp).isNotNull() & ~F.isnan(F.col(temp).cast("double")))
        if self.version == 3:
            alerts, carry = match_runs(due, *self.names, *self.rule, carried)
        else:
            alerts, carry = match_greedy(due, *self.names, *self.rule, self.version == 2, carried)
        self.buffer.keep(waiting, carry, batch_id)
        return alerts  # of a landed table


def hot_stream(df: DataFrame, key: str, ts: str, temp: str, tiebreak: str, threshold: float, tolerance_seconds: float,
               version: int, checkpoint: str, state_path: str, write: Callable[[DataFrame, int], None],
               delay_seconds: float = 0.0, trigger: Mapping | None = None) -> StreamingQuery:
    """Run V1, V2 or V3 on a stream and give each batch's closing readings to ``write``.

    The last readings wait for the watermark; at the end of a bounded input
    append a far-future reading to settle them.
    """
    matcher = HotMatcher(key, ts, temp, tiebreak, threshold, tolerance_seconds, version, state_path, delay_seconds)
    w = df.writeStream.foreachBatch(lambda b, i: write(matcher.step(b, i), i)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
