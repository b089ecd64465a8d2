"""Time windows: tumbling counts, word counts, and sessions.

Batch sessions are computed in two levels so a user with a third of all rows
is not one task: sessions are first found inside ``(key, time chunk)``
partitions, then the few chunk-local sessions per key are merged across chunk
boundaries.  Streaming sessions use Spark's ``session_window``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbend.functions.text import NON_WORD, tokens
from riverbend.operators.prefix import bucketed_prefix, sorted_buckets


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def tumbling_counts(df: DataFrame, ts: str, width: str, keys: str | Sequence[str] = ()) -> DataFrame:
    """Rows per epoch-aligned tumbling window of ``width`` and ``keys``.

    Output: ``window_start, window_end, *keys, cnt``.  A partial aggregate
    runs before the shuffle; on a stream add ``withWatermark`` first and
    windows are emitted once the watermark passes their end.
    """
    keys = _cols(keys)
    return (df.groupBy(F.window(ts, width).alias("w"), *keys)
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, "cnt"))


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of every lower-case token over whole texts: ``word, count``."""
    words = df.select(F.explode(F.split(F.lower(F.col(text)), NON_WORD)).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def windowed_word_count(df: DataFrame, text: str, ts: str, width: str) -> DataFrame:
    """Word counts per tumbling window (``window_start, window_end, word, count``)."""
    words = df.select(F.col(ts), F.explode(tokens(text)).alias("word"))
    return (words.groupBy(F.window(ts, width).alias("w"), "word")
                 .agg(F.count(F.lit(1)).alias("count"))
                 .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         "word", "count"))


def sessionize(df: DataFrame, key: str | Sequence[str], ts: str, gap_seconds: float,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sessions per key: rows at most ``gap_seconds`` apart share a session.

    Output: ``*key, activity_start, activity_end, num_interactions``.  Same
    rule as ``session_window``: a row exactly one gap after the previous one
    still joins its session.  The first level works inside bounded chunks of
    consecutive rows of a user, so even one very dense user is split over many
    tasks.  The second level joins chunk-local sessions across chunk boundaries
    with running aggregates over the same chunks, so no level gathers a user in
    one task.
    """
    key = _cols(key)
    gap_us = int(round(gap_seconds * 1_000_000))
    d = (df.filter(F.col(ts).isNotNull())
           .select(*key, F.unix_micros(F.col(ts)).alias("__us"), *tiebreak))
    d = sorted_buckets(d, key, [F.col("__us"), *[F.col(c) for c in tiebreak]], "__chunk")

    # Level 1: sessions inside each (key, chunk).
    w1 = Window.partitionBy(*key, "__chunk").orderBy("__us", *tiebreak)
    prev = F.lag("__us").over(w1)
    d = d.withColumn("__new", F.when(prev.isNull() | (F.col("__us") - prev > gap_us), 1).otherwise(0))
    d = d.withColumn("__local", F.sum("__new").over(w1.rowsBetween(Window.unboundedPreceding, 0)))
    local = d.groupBy(*key, "__chunk", "__local").agg(
        F.min("__us").alias("__first"), F.max("__us").alias("__last"),
        F.count(F.lit(1)).alias("__n"))

    merged = merge_sessions(local.drop("__local"), key, gap_us, order=["__chunk"], bucket="__chunk")
    return merged.select(*key, F.timestamp_micros("__first").alias("activity_start"),
                         F.timestamp_micros("__last").alias("activity_end"), F.col("__n").alias("num_interactions"))


def merge_sessions(parts: DataFrame, key: Sequence[str], gap_us: int, order: Sequence[str] = (), bucket: str | None = None) -> DataFrame:
    """Parts of sessions (``*key, __first, __last, __n``) to whole ones: parts within one gap of each other are one.

    The end of what stands before is a running maximum and the session id a
    running count of starts, both over buckets, so a user with very many parts is
    still spread over many tasks.  ``bucket`` names a column left by ``sorted_buckets``.
    """
    key = list(key)
    by = [F.col("__first"), *(F.col(c) for c in order)] if order else [F.col("__first"), F.col("__last")]
    parts = bucketed_prefix(parts, key, by, F.col("__last"), kind="max", out="__prev_last", bucket=bucket)
    parts = parts.withColumn("__new", F.when(F.col("__prev_last").isNull()
                                             | (F.col("__first") - F.col("__prev_last") > gap_us), 1).otherwise(0))
    parts = bucketed_prefix(parts, key, by, F.col("__new"), kind="sum", inclusive=True, out="__sid", bucket=bucket)
    return parts.groupBy(*key, "__sid").agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"),
                                            F.sum("__n").cast("long").alias("__n")).drop("__sid")


def session_activity_stream(df: DataFrame, key: str | Sequence[str], ts: str, gap: str,
                            delay: str = "0 seconds") -> DataFrame:
    """Streaming sessions with Spark's ``session_window`` (append or complete mode).

    A session is emitted once the watermark passes its end; at the end of a
    bounded input append a far-future sentinel row to close the last ones.
    """
    key = _cols(key)
    return (df.withWatermark(ts, delay)
              .groupBy(*key, F.session_window(ts, gap).alias("s"))
              .agg(F.min(ts).alias("activity_start"), F.max(ts).alias("activity_end"),
                   F.count(F.lit(1)).alias("num_interactions"))
              .select(*key, "activity_start", "activity_end", "num_interactions"))
