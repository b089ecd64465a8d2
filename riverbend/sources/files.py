"""File sources: CSV folders (watched), newline-delimited JSON, Parquet folders.

Schemas are always given; nothing is inferred from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riverbend.functions.time import ISO_WIRE_FORMAT


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Watch ``path`` for new headerless, unquoted CSV files (columns by position).

    Pair with ``trigger(processingTime="5 seconds")`` to poll, or
    ``availableNow`` to consume what is there and stop.  Files must be moved
    into the folder complete (written elsewhere, then renamed in).
    """
    r = (spark.readStream.schema(schema).option("header", "false").option("quote", "\u0000")
              .option("mode", "FAILFAST"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(path)


def csv_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", "false").option("quote", "\u0000")
                 .option("mode", "FAILFAST").csv(path))


def json_lines(spark: SparkSession, path: str, schema: T.StructType, stream: bool = False,
               timestamp_format: str = ISO_WIRE_FORMAT) -> DataFrame:
    """Newline-delimited JSON, one record per line, ISO wire timestamps."""
    r = spark.readStream if stream else spark.read
    return r.schema(schema).option("timestampFormat", timestamp_format).option("mode", "FAILFAST").json(path)


def parquet_folder(spark: SparkSession, path: str, schema: T.StructType, stream: bool = False,
                   max_files: int | None = None) -> DataFrame:
    """A Parquet folder read once, or watched for new files."""
    if not stream:
        return spark.read.schema(schema).parquet(path)
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)
