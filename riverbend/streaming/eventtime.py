"""Event time over micro-batches: rows wait until the watermark has passed them.

:class:`EventTimeBuffer` gives each micro-batch the rows that are due, from all
batches so far, and keeps those that wait, the watermark, and whatever small
table the caller carries from batch to batch, as one table under ``state_path`` per batch
id.  A replayed batch reads the same table and finds the same rows; tables of
batches that can't be replayed are deleted.  :func:`ordered_stream` uses it to put a
stream in event-time order per key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.operators.prefix import bucketed_prefix
from riverbend.session import land, remove


class EventTimeBuffer:
    """The watermark is the newest event time so far less ``delay_seconds``.

    A row is due once the watermark is past its time.  On arrival, a row behind the
    watermark of the batches before is dropped, and so is one without a time.
    """

    def __init__(self, ts: str, state_path: str, carry: T.StructType, delay_seconds: float = 0.0):
        self.ts, self.state_path, self.carry = ts, state_path.rstrip("/"), carry
        self.delay_us = int(round(delay_seconds * 1_000_000))
        self._marks: dict[int, int | None] = {}  # the watermark after the last batch, where this process ran it

    def _at(self, batch_id: int) -> str:
        return f"{self.state_path}/batch={batch_id}"

    def _schema(self, rows: T.StructType) -> T.StructType:
        return T.StructType([T.StructField("waiting", rows), T.StructField("carry", self.carry), T.StructField("watermark", T.LongType())])

    def _us(self) -> Column:
        return F.unix_micros(F.col(self.ts))

    def take(self, batch: DataFrame, batch_id: int, usable: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """``(due, waiting, carried)``: rows that are due, rows that wait, and the carry of the batch before (of the
        first: none).  Rows for which ``usable`` doesn't hold are no rows."""
        spark = batch.sparkSession
        rows = batch.filter(F.col(self.ts).isNotNull())
        if usable is not None:
            rows = rows.filter(usable)
        before, carried = None, None
        if batch_id > 0:
            state = spark.read.schema(self._schema(batch.schema)).parquet(self._at(batch_id - 1))
            before = self._marks.get(batch_id - 1) or state.agg(F.max("watermark")).first()[0]
            if before is not None:
                rows = rows.filter(self._us() >= F.lit(before))
            rows = rows.unionByName(state.filter("waiting IS NOT NULL").select("waiting.*"))
            carried = state.filter("carry IS NOT NULL").select("carry.*")
        newest = rows.agg(F.max(self._us())).first()[0]
        marks = [m for m in (before, None if newest is None else newest - self.delay_us) if m is not None]
        watermark = max(marks) if marks else None
        self._marks = {batch_id: watermark}
        past = F.coalesce(self._us() < F.lit(watermark).cast("long"), F.lit(False))
        return rows.filter(past), rows.filter(~past), carried

    def keep(self, waiting: DataFrame, carry: DataFrame, batch_id: int) -> None:
        """Store what the next batch needs."""
        spark, schema = waiting.sparkSession, self._schema(waiting.schema)
        empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields}
        clock = spark.range(1).select(empty["waiting"], empty["carry"], F.lit(self._marks[batch_id]).cast("long").alias("watermark"))
        state = clock.unionByName(waiting.select(F.struct(*waiting.columns).alias("waiting"), empty["carry"], empty["watermark"])).unionByName(
            carry.select(empty["waiting"], F.struct(*self.carry.names).alias("carry"), empty["watermark"]))
        state.write.mode("overwrite").parquet(self._at(batch_id))
        if batch_id > 1:  # the batch before may be replayed, and reads the table before it
            remove(spark, self._at(batch_id - 2))


def ordered_stream(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str], checkpoint: str, state_path: str,
                   write: Callable[[DataFrame, int], None], delay_seconds: float = 0.0, position: str = "position",
                   trigger: Mapping | None = None) -> StreamingQuery:
    """Rows in event-time order per key, with their place in it (1, 2, ...), once the watermark has passed them.

    The place is a running count over buckets of consecutive rows after the
    key's count so far, so a hot key is spread over many tasks.
    """
    schema = df.schema
    buffer = EventTimeBuffer(ts, state_path, T.StructType([T.StructField("key", schema[key].dataType), T.StructField("n", T.LongType())]), delay_seconds)

    def run(batch: DataFrame, batch_id: int) -> None:
        due, waiting, carried = buffer.take(batch, batch_id)
        order = [F.unix_micros(F.col(ts)), *(F.col(c) for c in tiebreak)]
        placed = bucketed_prefix(due, [key], order, F.lit(1).cast("long"), kind="sum", inclusive=True, out=position)
        if carried is not None:
            known = carried.select(F.col("key").alias("__key"), "n")
            placed = placed.join(known, F.col(key).eqNullSafe(F.col("__key")), "left").withColumn(
                position, F.col(position) + F.coalesce("n", F.lit(0))).drop("__key", "n")
        placed = land(placed, "ordered")
        counts = placed.groupBy(F.col(key).alias("key")).agg(F.max(position).alias("n"))
        if carried is not None:
            counts = counts.unionByName(carried).groupBy("key").agg(F.max("n").alias("n"))
        write(placed, batch_id)
        buffer.keep(waiting, counts, batch_id)

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
