"""Sessions on a stream, merged over micro-batches.

Every micro-batch finds the sessions among its own rows with the batch operator
(two levels, so a hot user is split over tasks) and merges them with the
sessions that are still open: intervals within one gap of each other become
one, also when a row that comes late bridges two of them.  A session is given out
once the watermark is more than a gap past its end; no row that may still come
can touch it.  Open sessions are a table under ``state_path`` per batch id, so a
replayed batch finds the same ones (``write`` must be idempotent per batch id).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.operators.windows import merge_sessions, sessionize
from riverbend.session import land, remove


def session_stream(df: DataFrame, key: str | Sequence[str], ts: str, gap_seconds: float, checkpoint: str, state_path: str,
                   write: Callable[[DataFrame, int], None], delay_seconds: float = 0.0, trigger: Mapping | None = None) -> StreamingQuery:
    """Sessions (``*key, activity_start, activity_end, num_interactions``) of a stream.

    The watermark is the newest event time so far less ``delay_seconds``; a row
    behind the watermark of the batches before is dropped, and so is one
    without a time.  At the end of a bounded input append a far-future row to
    close the last sessions.
    """
    spark, key = df.sparkSession, [key] if isinstance(key, str) else list(key)
    gap_us, delay_us = int(round(gap_seconds * 1_000_000)), int(round(delay_seconds * 1_000_000))
    open_ = T.StructType([*(df.schema[k] for k in key), *(T.StructField(c, T.LongType()) for c in ("__first", "__last", "__n"))])
    schema = T.StructType([T.StructField("open", open_), T.StructField("watermark", T.LongType())])
    at = lambda batch_id: f"{state_path.rstrip('/')}/batch={batch_id}"

    def run(batch: DataFrame, batch_id: int) -> None:
        us = F.unix_micros(F.col(ts))
        rows, before, state = batch.filter(F.col(ts).isNotNull()), None, None
        if batch_id > 0:
            state = spark.read.schema(schema).parquet(at(batch_id - 1))
            before = state.agg(F.max("watermark")).first()[0]
            if before is not None:
                rows = rows.filter(us >= F.lit(before))
        newest = rows.agg(F.max(us)).first()[0]
        marks = [m for m in (before, None if newest is None else newest - delay_us) if m is not None]
        watermark = max(marks) if marks else None
        own = sessionize(rows, key, ts, gap_seconds).select(
            *key, F.unix_micros("activity_start").alias("__first"), F.unix_micros("activity_end").alias("__last"), F.col("num_interactions").alias("__n"))
        if state is not None:
            own = merge_sessions(own.unionByName(state.filter("open IS NOT NULL").select("open.*")), key, gap_us)
        sessions = land(own, "sessions")
        done = F.col("__last") + F.lit(gap_us) < F.lit(watermark).cast("long")
        write(sessions.filter(done).select(*key, F.timestamp_micros("__first").alias("activity_start"),
                                           F.timestamp_micros("__last").alias("activity_end"), F.col("__n").alias("num_interactions")), batch_id)
        left = sessions.filter(~F.coalesce(done, F.lit(False))).select(F.struct(*open_.names).alias("open"), F.lit(None).cast("long").alias("watermark"))
        clock = spark.range(1).select(F.lit(None).cast(open_).alias("open"), F.lit(watermark).cast("long").alias("watermark"))
        left.unionByName(clock).write.mode("overwrite").parquet(at(batch_id))
        if batch_id > 1:  # the batch before may be replayed, and reads the table before it
            remove(spark, at(batch_id - 2))

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
