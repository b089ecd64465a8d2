"""Change feeds in the Debezium JSON envelope, already landed (files/Kafka).

``parse_cdc`` reads ``op, before, after, ts_ms`` and an ordering position;
``apply_cdc`` folds the changes into the current table: the last change per
key wins (an aggregation, so a hot key is reduced map-side) and keys whose
last change is a delete disappear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Debezium operation codes.
OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ = "c", "u", "d", "r"


def envelope_schema(row: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row), T.StructField("after", row),
        T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("source", T.StructType([T.StructField("lsn", T.LongType())])),
    ])


def split_cdc(df: DataFrame, value: str, row: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON change events -> ``(changes, bad)``.

    ``changes`` has ``op, before, after, ts_ms, lsn``.  ``bad`` has the input
    rows, unchanged, that are no change event: no JSON, a value that doesn't
    have its column's type, an unknown ``op``, or neither row image.
    """
    kept = "__bad_json"
    schema = T.StructType([*envelope_schema(row).fields, T.StructField(kept, T.StringType())])
    parsed = df.select("*", F.inline(F.array(F.struct(F.from_json(
        F.col(value), schema, {"columnNameOfCorruptRecord": kept}).alias("__e")))))  # parsed once a row
    e = F.col("__e")
    image = F.coalesce(e["after"], e["before"])
    good = (F.col(value).isNotNull() & e[kept].isNull() & image.isNotNull()
            & e["op"].isin(OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ))
    tagged = parsed.withColumn("__good", F.coalesce(good, F.lit(False)))
    changes = tagged.filter("__good").select("__e.op", "__e.before", "__e.after", "__e.ts_ms", F.col("__e.source.lsn").alias("lsn"))
    return changes, tagged.filter(~F.col("__good")).select(*df.columns)


def parse_cdc(df: DataFrame, value: str, row: T.StructType) -> DataFrame:
    """JSON change events -> ``op, before, after, ts_ms, lsn``; an event that
    isn't one fails the job.  Use :func:`split_cdc` to keep such events apart."""
    # a generator keeps later filters above the parse, so that it isn't copied into them
    parsed = df.select(F.inline(F.array(F.struct(F.from_json(F.col(value), envelope_schema(row), {"mode": "FAILFAST"}).alias("e"),
                                                 F.col(value).alias("v")))))
    known = F.col("e.op").isin(OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ) & F.coalesce("e.after", "e.before").isNotNull()
    op = F.when(known, F.col("e.op")).otherwise(F.raise_error(F.concat(F.lit("not a change event: "), F.coalesce("v", F.lit("null")))))
    return parsed.select(op.alias("op"), "e.before", "e.after", "e.ts_ms", F.col("e.source.lsn").alias("lsn"))


def after_images(changes: DataFrame) -> DataFrame:
    """The ``after`` row image of every change that has one (inserts, updates)."""
    return changes.filter(F.col("after").isNotNull()).select("after.*")


def apply_cdc(changes: DataFrame, key: str | Sequence[str], order: Sequence[str] = ("ts_ms", "lsn")) -> DataFrame:
    """Current table after all changes: last change per key by ``order``, deletes dropped."""
    keys = [key] if isinstance(key, str) else list(key)
    image = F.coalesce(F.col("after"), F.col("before"))
    keyed = changes.select(*[image.getField(k).alias(f"__k_{k}") for k in keys], "op", "after", *order)
    last = keyed.groupBy(*[f"__k_{k}" for k in keys]).agg(
        F.max_by(F.struct("op", "after"), F.struct(*order)).alias("__last"))
    return last.filter(F.col("__last.op") != F.lit(OP_DELETE)).select("__last.after.*")


def apply_cdc_stream(changes: DataFrame, key: str | Sequence[str],
                     order: Sequence[str] = ("ts_ms", "lsn")) -> DataFrame:
    """Streaming form of :func:`apply_cdc` (update output mode).

    Emits, per key changed in a micro-batch, its last change so far as
    ``*key, op, row``: the consumer upserts ``row`` or deletes the key when
    ``op`` is a delete (a stream cannot retract earlier output).  The state is
    one row per key, reduced map-side like the batch form.
    """
    keys = [key] if isinstance(key, str) else list(key)
    image = F.coalesce(F.col("after"), F.col("before"))
    keyed = changes.select(*[image.getField(k).alias(k) for k in keys], "op", "after", *order)
    last = keyed.groupBy(*keys).agg(F.max_by(F.struct("op", "after"), F.struct(*order)).alias("__last"))
    return last.select(*keys, F.col("__last.op").alias("op"), F.col("__last.after").alias("row"))
