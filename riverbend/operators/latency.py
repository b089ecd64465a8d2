"""Event-time lag: per-row lag and its distribution over the newest N rows."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The percentiles reported for the lag distribution.
LAG_PERCENTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)


def with_lag(df: DataFrame, ts: str, observed_at: Column | None = None, out: str = "lag_ms") -> DataFrame:
    """Add ``out`` = observation time minus event time, in milliseconds.

    ``observed_at`` defaults to ``current_timestamp()`` (streaming); pass a
    column to make a batch result deterministic.  Other columns pass through.
    """
    seen = observed_at if observed_at is not None else F.current_timestamp()
    return df.withColumn(out, F.unix_millis(seen) - F.unix_millis(F.col(ts)))


def lag_stats(df: DataFrame, lag: str, arrival: str, n: int = 10_000) -> DataFrame:
    """Statistics of ``lag`` over the ``n`` most recent rows by ``arrival``.

    The newest-n cut is a distributed top-n (each task keeps its n newest,
    then one merge), so at most ``n`` rows reach the final aggregate.
    Percentiles interpolate linearly between ranks.
    """
    recent = df.select(lag, arrival).orderBy(F.col(arrival).desc()).limit(n)
    pct = F.percentile(F.col(lag).cast("double"), list(LAG_PERCENTILES))
    stats = recent.agg(
        F.count(lag).alias("n"), F.min(lag).alias("min_ms"), F.max(lag).alias("max_ms"),
        F.avg(lag).alias("mean_ms"), F.stddev_samp(lag).alias("stddev_ms"), pct.alias("__p"))
    names = ["p50_ms", "p75_ms", "p95_ms", "p98_ms", "p99_ms", "p999_ms"]
    return stats.select("n", "min_ms", "max_ms", "mean_ms", "stddev_ms",
                        *[F.col("__p")[i].alias(nm) for i, nm in enumerate(names)])


def observe_lag(df: DataFrame, lag: str, name: str = "event_time_lag") -> DataFrame:
    """Attach lag metrics to a stream (or batch): count, mean, max and percentiles per micro-batch.

    Values appear in ``StreamingQueryProgress.observedMetrics[name]``; read
    them with :class:`LagMetrics` or any ``StreamingQueryListener``.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.avg(lag).alias("mean_lag_ms"),
                      F.max(lag).alias("max_lag_ms"),
                      F.percentile_approx(lag, list(LAG_PERCENTILES)).alias("percentiles_ms"))


try:  # listener base class (PySpark >= 3.4)
    from pyspark.sql.streaming.listener import StreamingQueryListener
except ImportError:  # pragma: no cover
    StreamingQueryListener = object  # type: ignore[misc,assignment]


class LagMetrics(StreamingQueryListener):
    """Collects the observed lag metrics of the newest ``keep`` progress reports
    (driver side; one small row per micro-batch)."""

    def __init__(self, name: str = "event_time_lag", keep: int = 1000):
        self.name, self.reports = name, deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.reports.append(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
