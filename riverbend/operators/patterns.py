""""Sensor stays hot too long" patterns, matched in event time per device.

Rows of a device are ordered by ``(ts, tiebreak)``; a reading is hot when
``temp >= threshold``.  Each pattern emits the *closing* reading of a match and
continues after it (skip past the last event).

* V3 - cool, then consecutive hot readings, then a hot reading at least
  ``tolerance`` after the first hot one: one alert per hot run that follows a
  cool reading.  Pure aggregation, no sequential step.
* V1 - a hot reading followed (anything in between) by a hot reading at least
  ``tolerance`` later.  Cool readings are ignored.
* V2 - as V1, but a cool reading in between cancels the match.

V1/V2 are greedy chains: each match starts at the first hot reading after the
previous match's end.  The chain is followed with pointer jumping over rank
tables (``log4`` rounds of equi-joins on unique ``(group, rank)`` keys), so no
device or run is ever gathered into one task.  Ranks, run starts and "first
reading at or after t" lookups are running aggregates computed in two levels
(:mod:`riverbend.operators.prefix`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riverbend.operators.prefix import bucketed_prefix
from riverbend.session import land, remove, scratch_dir

HOUR_US = 3_600 * 1_000_000


def readings(df: DataFrame, ts: str, temp: str, threshold: float) -> DataFrame:
    """Rows that count, with ``__us`` and ``__hot``.  A reading whose time or
    temperature is NULL or NaN is no reading, on streams as in batch."""
    return (df.filter(F.col(ts).isNotNull() & F.col(temp).isNotNull() & ~F.isnan(F.col(temp).cast("double")))
              .withColumn("__us", F.unix_micros(F.col(ts))).withColumn("__hot", F.col(temp) >= F.lit(threshold)))


def _runs(d: DataFrame, key: str, tiebreak: str) -> DataFrame:
    """``__run``: the number of cool readings up to and including this row."""
    return bucketed_prefix(d, [key], [F.col("__us"), F.col(tiebreak)], F.when(F.col("__hot"), 0).otherwise(1),
                           kind="sum", inclusive=True, out="__run")


def _as_readings(d: DataFrame, seeds: DataFrame) -> DataFrame:
    """``seeds`` (key, ``__us``, ``__hot``) in the columns of ``d``; all other values are NULL."""
    return seeds.select(*[F.col(c) if c in seeds.columns else F.lit(None).cast(d.schema[c].dataType).alias(c) for c in d.columns])


def match_runs(df: DataFrame, key: str, ts: str, temp: str, tiebreak: str, threshold: float, tolerance_seconds: float,
               carried: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """V3 ``(alerts, carry)``.

    ``carry`` is (key, ``us``, ``cool``), a row for each device that matters to later readings: its last reading is
    cool, or it is in a hot run after a cool reading, without an alert so far, that began at ``us``.  Given to the
    next call as ``carried``, with readings that are all later, it gives the alerts that one call over all would.
    """
    cols = df.columns
    tol = int(round(tolerance_seconds * 1_000_000))
    d = readings(df, ts, temp, threshold)
    if carried is not None:
        run = carried.filter(~F.col("cool"))
        d = d.unionByName(_as_readings(d, carried.filter("cool").select(key, F.col("us").alias("__us"), F.lit(False).alias("__hot")))).unionByName(
            _as_readings(d, run.select(key, (F.col("us") - 1).alias("__us"), F.lit(False).alias("__hot")))).unionByName(
            _as_readings(d, run.select(key, F.col("us").alias("__us"), F.lit(True).alias("__hot"))))
    rows = land(_runs(d, key, tiebreak), "runs")
    # the run's first time is the least one before a row: no run is joined or gathered
    seen = bucketed_prefix(rows.filter(F.col("__hot") & (F.col("__run") >= 1)), [key, "__run"],
                           [F.col("__us"), F.col(tiebreak)], F.col("__us"), kind="min", out="__first")
    late = F.col("__us") >= F.col("__first") + F.lit(tol)
    runs = land(seen.groupBy(key, "__run").agg(
        F.min_by(F.when(late, F.struct(*cols)), F.when(late, F.struct("__us", tiebreak))).alias("__row"),
        F.min("__us").alias("us")), "hot-runs")
    last = rows.groupBy(F.col(key).alias("__k")).agg(F.max(F.struct("__us", tiebreak, "__hot", "__run")).alias("__last"))
    at = last.join(runs, F.col("__k").eqNullSafe(F.col(key)) & (F.col("__last.__run") == F.col("__run")), "left")
    cool = ~F.col("__last.__hot")
    carry = at.filter(cool | F.col("us").isNotNull() & F.col("__row").isNull()).select(
        F.col("__k").alias(key), F.when(cool, F.col("__last.__us")).otherwise(F.col("us")).alias("us"), cool.alias("cool"))
    return runs.filter("__row IS NOT NULL").select("__row.*"), carry


def hot_v3(df: DataFrame, key: str, ts: str, temp: str, tiebreak: str, threshold: float,
           tolerance_seconds: float) -> DataFrame:
    """V3 alerts: the closing reading of each qualifying hot run (input columns)."""
    return match_runs(df, key, ts, temp, tiebreak, threshold, tolerance_seconds)[0]


def _chain(ends: DataFrame) -> DataFrame:
    """Ranks ``r`` on the greedy chain that starts at rank 1 of every group.

    ``ends``: ``__g, r, end`` - ``end`` is the closing rank of a match started
    at ``r``; the next match starts at ``end + 1``.  Returns ``__g, r`` for each
    chain member (and one rank past the group where the chain leaves it).

    Round k holds the jump table ``J_k`` (the start 4^k matches ahead) and the
    members found so far (chain positions ``0 .. 4^k - 1``); one round
    takes each member one, two and three jumps on, and squares ``J_k`` twice.  A
    jump that lands outside its group has no successor and is dropped by the
    join, so the table shrinks every round.  A round writes only its jumps and
    its new members, and the jumps before it are deleted.
    """
    spark = ends.sparkSession
    jump, jump_path = ends.select("__g", "r", (F.col("end") + 1).alias("a")), None
    found = [land(ends.filter(F.col("r") == 1).select("__g", "r"), "chain")]

    def after(left: DataFrame, right: DataFrame) -> DataFrame:
        """One jump by ``right`` from where ``left`` lands."""
        on = right.select(F.col("__g").alias("__g2"), F.col("r").alias("__r2"), F.col("a").alias("__a2"))
        return left.join(on, (F.col("__g") == F.col("__g2")) & (F.col("a") == F.col("__r2"))).select("__g", "r", F.col("__a2").alias("a"))

    while True:
        members = reduce(DataFrame.unionByName, found)
        steps = [members.select("__g", "r", F.col("r").alias("a"))]
        for _ in range(3):
            steps.append(after(steps[-1], jump))
        seen = Observation()
        new = land(reduce(DataFrame.unionByName, steps[1:]).select("__g", F.col("a").alias("r")).observe(seen, F.count(F.lit(1)).alias("n")), "chain")
        if not seen.get["n"]:
            break
        found.append(new)
        twice = after(jump, jump)
        path = scratch_dir(spark, "jumps")
        after_four = after(twice, twice)
        after_four.write.parquet(path)
        jump = spark.read.schema(after_four.schema).parquet(path)
        if jump_path:
            remove(spark, jump_path)
        jump_path = path
    if jump_path:
        remove(spark, jump_path)
    return reduce(DataFrame.unionByName, found)


def match_greedy(df: DataFrame, key: str, ts: str, temp: str, tiebreak: str, threshold: float, tolerance_seconds: float,
                 reset_on_cool: bool, carried: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """V1 (or V2, ``reset_on_cool``) ``(alerts, carry)``.

    ``carry`` is (key, ``us``, ``cool``), a row for each device with an open match, which began at ``us`` (``cool`` is
    false).  Given to the next call as ``carried``, with readings that are all later, the chain goes on from there.
    """
    cols = df.columns
    tol = int(round(tolerance_seconds * 1_000_000))
    d = readings(df, ts, temp, threshold)
    if carried is not None:
        d = d.unionByName(_as_readings(d, carried.select(key, F.col("us").alias("__us"), F.lit(True).alias("__hot"))))
    if reset_on_cool:
        d = land(_runs(d, key, tiebreak), "runs")
    group = F.struct(F.col(key), F.col("__run")) if reset_on_cool else F.struct(F.col(key))
    hot = d.filter("__hot").withColumn("__g", group)
    ranked = land(bucketed_prefix(hot, ["__g"], [F.col("__us"), F.col(tiebreak)], F.lit(1), kind="sum",
                                  inclusive=True, out="r"), "ranked")

    # end(r): first rank whose time is >= time(r) + tolerance, and > r.
    data = ranked.select("__g", F.col("__us").alias("t"), F.lit(1).alias("kind"),
                         F.col(tiebreak).alias("tb"), F.lit(1).alias("w"), F.lit(None).cast("long").alias("q"))
    query = ranked.select("__g", (F.col("__us") + F.lit(tol)).alias("t"), F.lit(0).alias("kind"),
                          F.col(tiebreak).alias("tb"), F.lit(0).alias("w"), F.col("r").alias("q"))
    counted = bucketed_prefix(data.unionByName(query), ["__g"], [F.col("t"), F.col("kind"), F.col("tb")],
                              F.col("w"), kind="sum", inclusive=True, out="before")
    ends = land(counted.filter(F.col("kind") == 0).select(
        "__g", F.col("q").alias("r"), (F.col("t") - F.lit(tol)).alias("us"),
        F.greatest(F.col("q") + 1, F.coalesce(F.col("before"), F.lit(0)) + 1).alias("end")), "ends")
    starts = _chain(ends).join(ends, ["__g", "r"]).select(F.col("__g").alias("__from"), "us", "end")
    closing = ranked.select("__g", "r", F.struct(*cols).alias("__row"))
    # an end past the group's last rank is no reading: the match stays open
    found = land(starts.join(closing, F.col("__from").eqNullSafe(F.col("__g")) & (F.col("end") == F.col("r")), "left"), "matches")
    left = found.filter("__row IS NULL").select(F.col(f"__from.{key}").alias(key), "us", *(["__from.__run"] if reset_on_cool else []))
    if reset_on_cool:  # only the run in which a device still is
        now = d.groupBy(F.col(key).alias("__k")).agg(F.max("__run").alias("__now"))
        left = left.join(now, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__run") == F.col("__now")))
    return found.filter("__row IS NOT NULL").select("__row.*"), left.select(key, "us", F.lit(False).alias("cool"))


def hot_v1(df: DataFrame, key: str, ts: str, temp: str, tiebreak: str, threshold: float,
           tolerance_seconds: float) -> DataFrame:
    """V1 alerts (closing readings); cool readings do not break a match."""
    return match_greedy(df, key, ts, temp, tiebreak, threshold, tolerance_seconds, False)[0]


def hot_v2(df: DataFrame, key: str, ts: str, temp: str, tiebreak: str, threshold: float,
           tolerance_seconds: float) -> DataFrame:
    """V2 alerts (closing readings); a cool reading cancels the open match."""
    return match_greedy(df, key, ts, temp, tiebreak, threshold, tolerance_seconds, True)[0]


# Pluggable matchers: every matcher has the signature
# (df, key, ts, temp, tiebreak, threshold, tolerance_seconds) -> closing readings.
MATCHERS = {"v1": hot_v1, "v2": hot_v2, "v3": hot_v3}
