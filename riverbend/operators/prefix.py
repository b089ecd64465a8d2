"""Running (prefix) aggregates per key, computed in two levels.

A plain ``max(x) OVER (PARTITION BY key ORDER BY o)`` sends every row of a key
to one task; a key holding a third of the data then runs in one task.  Here
the rows are first sorted by ``(keys, order)`` over the cluster and cut into
buckets of consecutive rows, ``2 ** BUCKET_BITS`` at most:

1. totals per ``(key, bucket)`` - a partial aggregation;
2. an exclusive running total over those bucket totals per key - a window over
   one row per bucket, not one row per event;
3. rows are joined to that carry and the in-bucket running aggregate is taken
   with a window partitioned by ``(key, bucket)``.

The cut follows the sorted position, so the number of buckets follows the row
count, a hot key is cut into many, and rows that tie in the first order column
are split by the next ones.  The sorted rows are written once to the shared
scratch folder: every later step reads the same buckets, also after an
executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbend.session import land

_AGGS = {"max": F.max, "min": F.min, "sum": F.sum}

# A bucket has 2 ** BUCKET_BITS rows at most: what one in-bucket window sorts.
BUCKET_BITS = 20


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "max":
        return F.greatest(carry, local)
    if kind == "min":
        return F.least(carry, local)
    # sum: a missing side contributes nothing; both missing stays NULL
    return F.when(carry.isNull() & local.isNull(), F.lit(None)).otherwise(
        F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)))


def sorted_buckets(df: DataFrame, keys: list[str], order: list[Column], out: str = "__rb_bucket") -> DataFrame:
    """``df``, landed, with column ``out``: a bucket number that never decreases
    along ``(keys, order)``, at most ``2 ** BUCKET_BITS`` rows each."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(k) for k in keys] + list(order)
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    # the id holds the partition number above the row's place in its partition
    bucket = F.shiftright(F.monotonically_increasing_id(), BUCKET_BITS)
    return land(ranged.withColumn(out, bucket), "sorted")


def bucketed_prefix(df: DataFrame, keys: list[str], order: list[Column], value: Column, kind: str = "max",
                    inclusive: bool = False, out: str = "prefix", bucket: str | None = None) -> DataFrame:
    """Add column ``out`` = running ``kind`` of ``value`` over earlier rows of the same keys.

    ``order`` should sort rows totally within a key.  ``inclusive`` also counts
    the current row.  NULL keys form their own group, as in a window, and NULL
    order values come first.  ``bucket`` names a column that a previous
    :func:`sorted_buckets` left on these rows, if it still never decreases
    along ``order``; otherwise the rows are sorted and cut here.
    """
    return bucketed_prefixes(df, keys, order, {out: value}, kind, inclusive, bucket)


def bucketed_prefixes(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, Column], kind: str = "max",
                      inclusive: bool = False, bucket: str | None = None) -> DataFrame:
    """As :func:`bucketed_prefix` for several values (``out: value``) over one order: the rows are sorted and joined once."""
    agg = _AGGS[kind]
    k, b = "__rb_key", "__rb_bucket"
    d = sorted_buckets(df, keys, order, b) if bucket is None else df.withColumn(b, F.col(bucket))
    # One struct key: never NULL itself, and NULL members compare equal in the
    # join, so a NULL key is a group of its own exactly as in a window.
    d = d.withColumn(k, F.struct(*keys)).withColumns({f"__rb_value{i}": v for i, v in enumerate(values.values())})
    n = range(len(values))

    totals = d.groupBy(k, b).agg(*(agg(f"__rb_value{i}").alias(f"__rb_total{i}") for i in n))
    w_bucket = Window.partitionBy(k).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(k, b, *(agg(f"__rb_total{i}").over(w_bucket).alias(f"__rb_carry{i}") for i in n))

    joined = d.join(carry, on=[k, b], how="inner")
    w_local = Window.partitionBy(k, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = joined.withColumns({name: _combine(kind, F.col(f"__rb_carry{i}"), agg(f"__rb_value{i}").over(w_local)) for i, name in enumerate(values)})
    return out.drop(k, b, *(f"__rb_value{i}" for i in n), *(f"__rb_carry{i}" for i in n))
