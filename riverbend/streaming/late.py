"""Late rows on a stream, with the same per-row rule as the batch operator.

Spark's own watermark only moves between micro-batches and silently drops
rows behind it in stateful operators.  Here every micro-batch is split with
:func:`riverbend.operators.routing.split_late`, seeded with the largest event
time seen so far per source partition.  That carry is a tiny table written
under ``state_path`` per batch id, so a replayed batch reads the same carry and
rewrites the same outputs (outputs must be idempotent per batch id).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.operators.routing import tag_late
from riverbend.session import land, remove

_MIN_OFFSET = -(2 ** 63)


def _carry_path(state_path: str, batch_id: int) -> str:
    return f"{state_path.rstrip('/')}/batch={batch_id}"


def split_late_stream(df: DataFrame, ts: str, offset: str, source_partition: str,
                      on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None],
                      checkpoint: str, state_path: str,
                      trigger: Mapping | None = None) -> StreamingQuery:
    """Route each row of a stream to ``on_time`` or ``late`` writers."""
    spark = df.sparkSession
    cols = df.columns
    carry_schema = T.StructType([df.schema[source_partition], T.StructField("__max_ms", T.LongType())])

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("__carry", F.lit(False))
        if batch_id > 0:
            # explicit schema: an empty earlier batch may have left no data file
            prev = spark.read.schema(carry_schema).parquet(_carry_path(state_path, batch_id - 1))
            seed = prev.select(
                *[(F.timestamp_millis("__max_ms") if c == ts else
                   F.lit(_MIN_OFFSET).cast(batch.schema[c].dataType) if c == offset else
                   F.col(source_partition) if c == source_partition else
                   F.lit(None).cast(batch.schema[c].dataType)).alias(c) for c in cols],
                F.lit(True).alias("__carry"))
            batch = batch.unionByName(seed)
        # tagged once; both outputs and the carry read the tagged rows
        tagged = land(tag_late(batch, ts, offset, source_partition), "late-batch")
        rows = tagged.filter(~F.col("__carry")).drop("__carry")
        on_time(rows.filter(~F.col("__late")).drop("__late"), batch_id)
        late(rows.filter("__late").drop("__late"), batch_id)
        (tagged.groupBy(source_partition).agg(F.max(F.unix_millis(F.col(ts))).alias("__max_ms"))
               .coalesce(1).write.mode("overwrite").parquet(_carry_path(state_path, batch_id)))
        for path in tagged.inputFiles()[:1]:
            remove(spark, path.rsplit("/", 1)[0])
        if batch_id > 1:  # the batch before may be replayed, and reads the carry before it
            remove(spark, _carry_path(state_path, batch_id - 2))

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
