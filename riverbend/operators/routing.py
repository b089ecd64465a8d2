"""Routing: split by value, dead-letter split, late-row split.

Outputs are lazy filters over one input, so an output nobody reads costs
nothing.  To write several outputs of one stream while reading the source
once, use :func:`riverbend.streaming.sinks.fan_out`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.functions.json import json_verdict, parse_struct
from riverbend.functions.time import wire_timestamp
from riverbend.operators.prefix import bucketed_prefix, bucketed_prefixes


def route_label(column: str, routes: Mapping[str, str], default: str | None = None) -> Column:
    """Output name for each row: ``routes[value]``, else ``default`` (may be NULL)."""
    expr = None
    for value, name in routes.items():
        cond = F.col(column) == F.lit(value)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def split_by(df: DataFrame, column: str, routes: Mapping[str, str],
             default: str | None = None) -> dict[str, DataFrame]:
    """One filtered DataFrame per output name (values with the same name share it)."""
    label = route_label(column, routes, default)
    names = list(dict.fromkeys(list(routes.values()) + ([default] if default else [])))
    return {n: df.filter(label == F.lit(n)) for n in names}


def labelled(df: DataFrame, column: str, routes: Mapping[str, str], default: str | None = None,
             out: str = "output") -> DataFrame:
    """All outputs in one pass, tagged with their name in column ``out``."""
    return df.withColumn(out, route_label(column, routes, default))


def dead_letter_split(df: DataFrame, value: str, schema: T.StructType, required: Sequence[str],
                      allow_unknown: bool = False, time_fields: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse the JSON text in ``value``; rows that do not map onto ``schema``
    go to the second output unchanged (the original text), the rest to the
    first output as typed records.

    ``time_fields`` are read as text and then parsed from either decimal epoch
    seconds or ISO-8601 (the two wire encodings).
    """
    read_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in time_fields else f.dataType, True)
        for f in schema.fields])
    # Parse once per row: ``inline`` of a one-element array is a Generate, and
    # Catalyst cannot push the routing filter below it, so the parse is not
    # inlined (and repeated) into both the filter and the output projection.
    parsed = df.select("*", F.inline(F.array(F.struct(
        parse_struct(F.col(value), read_schema).alias("__parsed"),
        F.json_object_keys(F.col(value)).alias("__keys")))))
    verdict = json_verdict(F.col(value), F.col("__parsed"), read_schema, required, allow_unknown,
                           keys=F.col("__keys"))
    for name in time_fields:
        # an unparseable time is a bad record too
        raw = F.col("__parsed").getField(name)
        verdict = verdict & (raw.isNull() | wire_timestamp(raw).isNotNull())
    tagged = parsed.withColumn("__ok", verdict).drop("__keys")
    fields = []
    for f in schema.fields:
        c = F.col("__parsed").getField(f.name)
        fields.append((wire_timestamp(c) if f.name in time_fields else c).alias(f.name))
    good = tagged.filter("__ok").select(*fields)
    bad = tagged.filter(~F.col("__ok")).drop("__parsed", "__ok")
    return good, bad


def tag_late(df: DataFrame, ts: str, offset: str, source_partition: str | None = None,
             out: str = "__late") -> DataFrame:
    """Tag rows that arrive behind the event-time watermark.

    Watermark seen by a row = (largest event time, in ms, among earlier rows of
    its source partition) - 1 ms; a row is late iff its own time in ms is below
    it.  Earlier = smaller ``offset`` in the same ``source_partition``.  The
    running maximum is taken in bounded buckets, so one partition (or one hot
    source) is still spread over many tasks.
    """
    keys = [source_partition] if source_partition else []
    tmp = df if keys else df.withColumn("__one_source", F.lit(0))
    keys = keys or ["__one_source"]
    with_wm = bucketed_prefix(tmp, keys, [F.col(offset)], F.unix_millis(F.col(ts)), kind="max", out="__max_prev")
    late = F.coalesce(F.unix_millis(F.col(ts)) < F.col("__max_prev") - 1, F.lit(False))
    return with_wm.withColumn(out, late).drop("__max_prev", "__one_source")


def split_late(df: DataFrame, ts: str, offset: str,
               source_partition: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(on_time, late)`` rows by :func:`tag_late`; both read the rows tagged once."""
    tagged = tag_late(df, ts, offset, source_partition)
    return tagged.filter(~F.col("__late")).drop("__late"), tagged.filter("__late").drop("__late")


def tag_late_combined(df: DataFrame, ts: str, offset: str, source_partition: str, partitions: Sequence, arrival: str,
                      idle_ms: int, out: str = "__late") -> DataFrame:
    """Tag rows behind a watermark that is combined over source partitions.

    Rows arrive in the order of ``offset``, at ``arrival`` (a timestamp that doesn't fall).  A
    partition's own watermark is the newest event time, in ms, among its rows so
    far, less 1 ms; the combined one is the least of those of the partitions that
    aren't idle.  A partition is idle when its last row (or, if it has none,
    the first row of all) came more than ``idle_ms`` before the present row; one that isn't idle
    and has no row yet holds the watermark back, and so does it while all are idle.  A row is
    late iff its time is below the combined watermark of the rows before it.

    The running maxima of all ``partitions`` (values of ``source_partition``; a few
    hundred at most) are taken in one pass over bounded buckets of rows, so a
    partition with most of the rows is spread over many tasks.
    """
    at, ms = F.unix_millis(F.col(arrival)), F.unix_millis(F.col(ts))
    own = lambda p, v: F.when(F.col(source_partition) == F.lit(p), v)
    values = {f"__newest{i}": own(p, ms) for i, p in enumerate(partitions)} | {f"__came{i}": own(p, at) for i, p in enumerate(partitions)}
    d = bucketed_prefixes(df.withColumn("__one", F.lit(0)), ["__one"], [F.col(offset)], values | {"__begin": -at}, kind="max")
    begin = -F.col("__begin")  # the first arrival of all, as the greatest negative
    n = range(len(partitions))
    active = [at - F.coalesce(F.col(f"__came{i}"), begin) <= idle_ms for i in n]
    # an active partition without rows has no watermark: it holds back
    held = reduce(Column.__or__, [a & F.col(f"__newest{i}").isNull() for i, a in zip(n, active, strict=True)])
    least = F.array_min(F.array(*[F.when(a, F.col(f"__newest{i}")) for i, a in zip(n, active, strict=True)]))
    late = F.coalesce(~held & (ms < least - 1), F.lit(False))
    return d.withColumn(out, late).drop("__one", *values, "__begin")


__all__ = ["tag_late_combined", "route_label", "split_by", "labelled", "dead_letter_split", "tag_late", "split_late"]
