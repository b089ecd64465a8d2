"""Lag distribution over the newest N samples of a stream.

Each micro-batch merges its lag samples into the previous batch's newest-N
table (at most N rows, written per batch id under ``state_path`` so a
replayed batch reads and writes the same versions), then computes the same
statistics as the batch operator and hands them to ``on_stats``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.operators.latency import lag_stats


def _path(state_path: str, batch_id: int) -> str:
    return f"{state_path.rstrip('/')}/batch={batch_id}"


def lag_stats_stream(df: DataFrame, lag: str, arrival: str, n: int, checkpoint: str, state_path: str,
                     on_stats: Callable[[DataFrame, int], None],
                     trigger: Mapping | None = None) -> StreamingQuery:
    spark = df.sparkSession
    kept_schema = T.StructType([df.schema[lag], df.schema[arrival]])

    def run(batch: DataFrame, batch_id: int) -> None:
        samples = batch.select(lag, arrival)
        if batch_id > 0:
            # explicit schema: an empty earlier batch may have left no data file
            samples = samples.unionByName(
                spark.read.schema(kept_schema).parquet(_path(state_path, batch_id - 1)))
        newest = samples.orderBy(samples[arrival].desc()).limit(n)  # distributed top-n, <= n rows
        newest.coalesce(1).write.mode("overwrite").parquet(_path(state_path, batch_id))
        kept = spark.read.schema(kept_schema).parquet(_path(state_path, batch_id))
        on_stats(lag_stats(kept, lag, arrival, n), batch_id)

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
