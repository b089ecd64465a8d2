"""Changelog of the latest row per key on a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.operators.changelog import latest_changelog
from riverbend.session import remove


def latest_changelog_stream(df: DataFrame, key: str | Sequence[str], order: Sequence[str], arrival: str, checkpoint: str,
                            state_path: str, write: Callable[[DataFrame, int], None], deleted: Column | None = None,
                            trigger: Mapping | None = None) -> StreamingQuery:
    """Streaming form of :func:`riverbend.operators.changelog.latest_changelog`.

    Every micro-batch runs the batch operator after the newest row of each key
    so far, a table under ``state_path`` per batch id; keys that a batch doesn't touch
    are carried as they are.  ``arrival`` must not fall from batch to batch.  A replayed
    batch reads the same table and writes the same log (``write`` must be
    idempotent per batch id).
    """
    spark, keys = df.sparkSession, [key] if isinstance(key, str) else list(key)
    schema = T.StructType([T.StructField("row", df.schema), T.StructField("gone", T.BooleanType())])
    at = lambda batch_id: f"{state_path.rstrip('/')}/batch={batch_id}"

    def run(batch: DataFrame, batch_id: int) -> None:
        carried, rest = None, None
        if batch_id > 0:
            before = spark.read.schema(schema).parquet(at(batch_id - 1)).withColumn("__key", F.struct(*(F.col(f"row.{k}") for k in keys)))
            touched = batch.select(F.struct(*keys).alias("__key")).distinct()
            carried, rest = (before.join(touched, "__key", how).select("row", "gone") for how in ("left_semi", "left_anti"))
        log, newest = latest_changelog(batch, keys, order, arrival, deleted, carried)
        write(log, batch_id)
        newest = newest.select(F.col("row").cast(df.schema).alias("row"), "gone")
        (newest if rest is None else newest.unionByName(rest)).write.mode("overwrite").parquet(at(batch_id))
        if batch_id > 1:  # the batch before may be replayed, and reads the table before it
            remove(spark, at(batch_id - 2))

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
