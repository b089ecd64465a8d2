"""Readers for the parquet tables under an ``sf`` folder.

The files store zone-less timestamps, which Spark reads as TIMESTAMP_NTZ.
Watermarks and ``unix_millis`` need TIMESTAMP, so every reader here casts
them (session zone UTC, so no wall-clock shift happens).  Results meant for
comparison with a zone-less engine are cast back with :func:`to_ntz`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one table, optionally projected, with NTZ timestamps cast to TIMESTAMP."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return ltz(df)


def ltz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP_NTZ column to TIMESTAMP (same wall clock in UTC)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every top-level TIMESTAMP column back to TIMESTAMP_NTZ."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
