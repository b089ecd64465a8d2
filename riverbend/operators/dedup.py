"""Deduplication family: distinct rows, keep first / latest per key, latest
improvements, and the deduplicated join.

Batch forms are aggregations where possible (``min_by`` / ``max_by`` over a
struct), so each map task reduces a hot key to one row before the shuffle.
Streaming forms use the operators Spark allows on unbounded input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbend.operators.prefix import bucketed_prefix


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT *`` (or distinct on ``subset``).

    Batch: hash aggregate with a map-side partial step.  Streaming: Spark keeps
    the seen keys in state; pair it with a watermark to bound that state.
    """
    return df.dropDuplicates(list(subset) if subset else None)


def _pick(df: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    payload = [c for c in df.columns]
    picked = df.groupBy(*key).agg(
        pick(F.struct(*payload), F.struct(*[F.col(c) for c in order])).alias("__row"))
    return picked.select("__row.*")


def keep_first(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """First row per key by ``order`` (``ROW_NUMBER() ... ASC = 1``).

    ``order`` must end with a tiebreak column so the choice is deterministic.
    """
    return _pick(df, _cols(key), _cols(order), F.min_by)


def keep_first_stream(df: DataFrame, key: str | Sequence[str], ts: str, delay: str) -> DataFrame:
    """Streaming keep-first: first *arrival* per key within the watermark delay.

    Spark rejects ``ROW_NUMBER`` on a stream; ``dropDuplicatesWithinWatermark``
    keeps state for a key only until the watermark passes its first event time
    plus ``delay`` (the analogue of a state TTL).
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(_cols(key))


def keep_latest(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], n: int = 1,
                rank_col: str | None = None) -> DataFrame:
    """Latest ``n`` rows per key by ``order`` (``ROW_NUMBER() ... DESC <= n``).

    ``n == 1`` is an aggregation (``max_by`` of the row), valid on a stream in
    update/complete mode.  ``n > 1`` is a ranked window; Spark plans it with a
    partial ``WindowGroupLimit`` before the shuffle, so each map task forwards
    at most ``n`` rows per key.
    """
    key, order = _cols(key), _cols(order)
    if n == 1 and rank_col is None:
        return _pick(df, key, order, F.max_by)
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    rc = rank_col or "__rank"
    out = df.withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n)
    return out if rank_col else out.drop(rc)


def latest_improvements(df: DataFrame, key: str | Sequence[str], ts: str, arrival: str,
                        tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows that are the first for their key, or strictly newer (by ``ts``) than
    every earlier arrival of that key; ties keep the stored row.

    ``arrival`` is an arrival position (e.g. a source offset); the running
    maximum is computed in bounded buckets, so a hot key is spread over many
    tasks (see :mod:`riverbend.operators.prefix`).
    """
    order = [F.col(arrival)] + [F.col(c) for c in tiebreak]
    with_prev = bucketed_prefix(df, _cols(key), order, F.col(ts), kind="max", out="__prev_ts")
    keep = F.col("__prev_ts").isNull() | (F.col(ts) > F.col("__prev_ts"))
    return with_prev.filter(keep).drop("__prev_ts")


def dedup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               select: Sequence[Column] | None = None) -> DataFrame:
    """Inner equi-join of ``left`` with the distinct rows of ``right``.

    Catalyst/AQE choose broadcast or sort-merge from runtime sizes; the skew
    rule splits a partition that a hot key inflated.  On streams both inputs
    need watermarks and a time bound, otherwise the join state grows forever.
    """
    joined = left.join(distinct_rows(right), left[left_key] == F.col(right_key), "inner")
    return joined.select(*select) if select else joined


def dedup_join_stream(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      left_ts: str | None = None, right_ts: str | None = None, delay: str | None = None,
                      max_gap: str | None = None, select: Sequence[Column] | None = None) -> DataFrame:
    """Stream-stream form of :func:`dedup_join`.

    Without ``max_gap`` every pair joins, however far apart, and Spark keeps
    all rows of both sides in its (on-disk) state.  With it, both sides get a
    watermark of ``delay``, right rows are deduplicated within the watermark
    and must fall within ``max_gap`` of their left row; state is then dropped
    once the watermark passes.
    """
    if max_gap is None:
        return dedup_join(left, right, left_key, right_key, select)
    lw = left.withWatermark(left_ts, delay)
    rw = right.withWatermark(right_ts, delay).dropDuplicatesWithinWatermark()
    cond = ((lw[left_key] == rw[right_key])
            & (rw[right_ts] >= lw[left_ts] - F.expr(f"INTERVAL {max_gap}"))
            & (rw[right_ts] <= lw[left_ts] + F.expr(f"INTERVAL {max_gap}")))
    joined = lw.join(rw, cond, "inner")
    return joined.select(*select) if select else joined
