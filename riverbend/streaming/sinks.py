"""Sinks: day-partitioned Parquet, compaction, fan-out, exactly-once copies.

All output folders live below the session's shared checkpoint folder unless
the caller passes its own path.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riverbend.session import land, scratch_dir, ship_package


def new_output(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


def _by_folder(df: DataFrame, partition_col: str, split_by: str | None, tasks: int | None) -> DataFrame:
    """Ranges of ``(folder, hash of the row)``: a small folder lies in one range, and so in one file; a folder with
    many rows spans several ranges, written by as many tasks.  One shuffle, no count and no join."""
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, F.col(partition_col), F.xxhash64(*([split_by] if split_by else df.columns)))


def write_partitioned(df: DataFrame, partition_col: str, path: str, mode: str = "errorifexists",
                      split_by: str | None = None, tasks: int | None = None) -> str:
    """Batch write partitioned by ``partition_col``, one file per folder unless
    the folder is large (or lies across the border of two ranges).

    ``split_by`` is the column whose hash spreads a large folder's rows over
    tasks; by default all columns are hashed.
    """
    _by_folder(df, partition_col, split_by, tasks).write.mode(mode).partitionBy(partition_col).parquet(path)
    return path


def files_per_folder(table: DataFrame, partition_col: str) -> DataFrame:
    """``partition_col, n_files`` of a partitioned table read from Parquet."""
    files = table.select(partition_col, F.col("_metadata.file_path").alias("f")).distinct()
    return files.groupBy(partition_col).agg(F.count("f").alias("n_files"))


def compact(spark: SparkSession, path: str, partition_col: str, schema: T.StructType, where: str | None = None,
            split_by: str | None = None) -> int:
    """Rewrite the folders of a batch-written partitioned table (or those that
    ``where`` selects) that have more than one file, in place; returns how many
    files these had.  Rows are unchanged and other folders aren't touched.

    The rows are landed first and the folders then replaced by a dynamic
    partition overwrite.  Not for a streaming sink's folder: its
    ``_spark_metadata`` log names the original files.
    """
    table = spark.read.schema(schema).parquet(path)
    counts = files_per_folder(table, partition_col)
    many = land((counts.filter(where) if where else counts).filter("n_files > 1"), "fragmented")
    n_files = many.agg(F.sum("n_files")).first()[0]
    if n_files is None:
        return 0
    kept = land(table.join(many.select(F.col(partition_col).alias("__part")),
                           F.col(partition_col).eqNullSafe(F.col("__part"))).drop("__part"), "fragments")
    (_by_folder(kept, partition_col, split_by, None).write.mode("overwrite").partitionBy(partition_col)
        .option("partitionOverwriteMode", "dynamic").parquet(path))
    return n_files


def stream_partitioned(df: DataFrame, partition_col: str, path: str, checkpoint: str,
                       trigger: Mapping | None = None) -> StreamingQuery:
    """Streaming day-partitioned Parquet; files become visible per committed batch."""
    w = (df.writeStream.format("parquet").partitionBy(partition_col)
           .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def fan_out(df: DataFrame, outputs: Mapping[str, tuple[Callable[[DataFrame], DataFrame],
                                                       Callable[[DataFrame, int], None]]],
            checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Several outputs from one stream, reading the source once per batch.

    ``outputs[name] = (transform, write)``; every micro-batch is cached, each
    transform runs on it and ``write(result, batch_id)`` stores the result.
    Writers should be idempotent per ``batch_id`` (a batch is replayed after a
    failure).
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for transform, write in outputs.values():
                write(transform(batch), batch_id)
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def parquet_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Idempotent per-batch writer: batch ``b`` owns folder ``batch_id=b`` and
    a replay overwrites it, so every batch lands exactly once."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def exactly_once_copy(df: DataFrame, path: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Copy a stream to Parquet exactly once.

    The file sink commits each batch in its ``_spark_metadata`` log together
    with the source offsets in the checkpoint, so a restart neither loses nor
    repeats rows (Spark's Kafka sink is at-least-once; this is the
    exactly-once route).
    """
    w = (df.writeStream.format("parquet").option("path", path)
           .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def print_sink(df: DataFrame, checkpoint: str, prefix: str | None = None, to_stderr: bool = False,
               trigger: Mapping | None = None) -> StreamingQuery:
    """Print every row of a stream, as JSON, where it is: in the executors' output
    (the console in local mode).  ``prefix`` tags every line; nothing reaches the driver."""
    ship_package(df.sparkSession)
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))
    w = lines.writeStream.foreach(LinePrinter(prefix, to_stderr)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


class LinePrinter:
    """Writer of :func:`print_sink`: one line per row."""

    def __init__(self, prefix: str | None, to_stderr: bool):
        self.prefix, self.to_stderr = prefix, to_stderr

    def process(self, row) -> None:
        out = sys.stderr if self.to_stderr else sys.stdout
        out.write(f"{self.prefix}> {row.line}\n" if self.prefix else f"{row.line}\n")  # one write: lines stay whole
        out.flush()


def discard(df: DataFrame, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Run a stream for its side effects (state, metrics) and drop the rows."""
    w = df.writeStream.format("noop").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
