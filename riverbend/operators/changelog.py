"""Changelogs: the table of the latest row per key as a log of row changes.

A log row has ``kind`` and the table's columns.  ``+I`` enters a row for a new
key; ``-U`` takes back the row a key had and ``+U`` puts the new one in its place;
``-D`` takes a row out.  So every row that enters is taken back once at most, and
consumers that only add and take back (sums, counts, joins) stay right.

What a key had before is a running maximum of the row struct, taken in
bounded buckets of consecutive rows (:mod:`riverbend.operators.prefix`), so a
hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.operators.prefix import bucketed_prefix
from riverbend.session import land

# The four kinds of row changes.
INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


def _kinds(new: Column, old: Column, had: Column, has: Column) -> Column:
    """The changes of one event as an array of (step, kind, row): -U before +U."""
    def change(step: int, kind: str, row: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), row.alias("row"))

    return (F.when(had & has, F.array(change(0, BEFORE, old), change(1, AFTER, new)))
             .when(has, F.array(change(1, INSERT, new))).when(had, F.array(change(0, DELETE, old))))


def latest_changelog(df: DataFrame, key: str | Sequence[str], order: Sequence[str], arrival: str,
                     deleted: Column | None = None, carried: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(log, carry)`` of the latest row per key by ``order``, rows taken one by one as they arrive.

    ``log``: ``arrival, step, kind`` and the columns of ``df``, two rows (steps 0
    and 1) for an update.  A row that isn't newer than its key's row changes
    nothing; on a tie the stored row stays.  A row for which ``deleted`` holds takes the
    key out (its position in ``order`` stays known, so an older row doesn't bring the
    key back).  ``arrival`` is a number, unique within a key.  ``carry`` is the newest row of each
    key, deleted ones included; given to the next call as ``carried``, with
    rows that all arrive later, the log goes on.  A NULL key is a key; rows with NULL in
    ``order`` are older than all others.
    """
    keys, cols = ([key] if isinstance(key, str) else list(key)), df.columns
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    state = F.struct(F.struct(*order).alias("at"), (-F.col(arrival)).alias("first"), F.col("__gone").alias("gone"), F.struct(*cols).alias("row"))
    rows = df.withColumn("__gone", gone).withColumn("__new", F.lit(True))
    if carried is not None:
        before = carried.select("row.*", F.col("gone").alias("__gone"), F.lit(False).alias("__new"))
        rows = rows.unionByName(before)
    # the greatest by order, of equal ones the first to come: the row that is stored when another arrives
    seen = bucketed_prefix(rows, keys, [F.col("__new"), F.col(arrival)], state, kind="max", out="__old")
    newer = F.col("__old").isNull() | (F.struct(*order) > F.col("__old.at"))
    moves = land(seen.withColumn("__newer", newer), "moves").filter("__newer")
    had = F.col("__old").isNotNull() & ~F.coalesce(F.col("__old.gone"), F.lit(True))
    changes = _kinds(F.struct(*cols), F.col("__old.row"), had, ~F.col("__gone"))
    log = moves.filter("__new").select(F.col(arrival).alias("arrival"), F.explode(changes).alias("c")).select(
        "arrival", "c.step", "c.kind", "c.row.*")
    newest = moves.groupBy(*keys).agg(F.max_by(F.struct(F.struct(*cols).alias("row"), F.col("__gone").alias("gone")), F.struct(*order)).alias("s"))
    return log, newest.select("s.row", "s.gone")


def fold_changelog(log: DataFrame, columns: Sequence[str], kind: str = "kind") -> DataFrame:
    """The table that a changelog describes: every row as often as it was entered and not taken back.

    Entering counts one, taking back minus one; a partial aggregate, whatever the
    order in which the log is read.  A row taken back more often than entered fails the job.
    """
    sign = F.when(F.col(kind).isin(INSERT, AFTER), 1).otherwise(-1)
    left = log.groupBy(*columns).agg(F.sum(sign).alias("__n"))
    n = F.when(F.col("__n") >= 0, F.col("__n")).otherwise(F.raise_error(F.lit("a row is taken back that was never entered")))
    return left.withColumn("__n", n).filter("__n > 0").withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).drop("__n")


def retracting_totals(log: DataFrame, by: str | Sequence[str], value: str, kind: str = "kind") -> DataFrame:
    """``*by, n, total`` of the current table, kept by adding what enters and subtracting what is taken back; on a
    stream of log rows the same aggregate runs in update mode.  Groups of which nothing is left are dropped."""
    sign = F.when(F.col(kind).isin(INSERT, AFTER), 1).otherwise(-1)
    by = [by] if isinstance(by, str) else list(by)
    return log.groupBy(*by).agg(F.sum(sign).alias("n"), F.sum(F.col(value) * sign).alias("total")).filter("n > 0")


def image_breaks(changes: DataFrame, key: str | Sequence[str], lsn: str = "lsn") -> tuple[DataFrame, DataFrame]:
    """``(whole, broken)`` change events (``op, before, after, lsn``) by the continuity of their row images.

    In the order of ``lsn`` an event's ``before`` must equal the ``after`` of the key's
    event before it (of none: NULL).  ``broken`` has the events for which it doesn't, with
    ``expected``, that image, and ``fault``: ``repeat`` (an event that was there already,
    by op and images), ``gap`` (something between is missing) or ``no_history``
    (a ``before`` where the key has none).  A delete leaves NULL.
    """
    keys = [key] if isinstance(key, str) else list(key)
    image = F.coalesce(F.col("after"), F.col("before"))
    rows = changes.withColumns({f"__k_{k}": image.getField(k) for k in keys})
    here = F.struct(F.col(lsn), F.struct("op", "before", "after").alias("e"))
    seen = bucketed_prefix(rows, [f"__k_{k}" for k in keys], [F.col(lsn)], here, kind="max", out="__old")
    expected, same = F.col("__old.e.after"), F.struct("op", "before", "after").eqNullSafe(F.col("__old.e"))
    fault = (F.when(F.col("before").eqNullSafe(expected), F.lit(None)).when(same, "repeat")
              .when(expected.isNull(), "no_history").otherwise("gap"))
    tagged = land(seen.select(*changes.columns, expected.alias("expected"), fault.alias("fault")), "images")
    return tagged.filter("fault IS NULL").select(*changes.columns), tagged.filter("fault IS NOT NULL")
