"""Event-time lag: pass-through and distribution statistics."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from riverbend.operators import latency


def test_pass_through(spark):
    # G6: (0, "", epoch) comes out unchanged, lag added
    df = spark.createDataFrame([(0, "", dt.datetime(1970, 1, 1))], "id long, name string, timestamp timestamp")
    out = latency.with_lag(df, "timestamp", F.lit(dt.datetime(1970, 1, 1, 0, 0, 1))).first()
    assert (out.id, out.name, out.timestamp, out.lag_ms) == (0, "", dt.datetime(1970, 1, 1), 1000)
    assert latency.with_lag(df, "timestamp").first().lag_ms > 0


def test_stats_over_newest_n(spark):
    rng = np.random.default_rng(3)
    lags = rng.integers(0, 5000, 500)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(lags)], "arrival long, lag_ms long")
    s = latency.lag_stats(df, "lag_ms", "arrival", n=200).first()
    newest = lags[-200:].astype(float)
    assert s.n == 200 and s.min_ms == newest.min() and s.max_ms == newest.max()
    assert abs(s.mean_ms - newest.mean()) < 1e-9
    assert abs(s.stddev_ms - newest.std(ddof=1)) < 1e-6
    for q, v in zip(latency.LAG_PERCENTILES, (s.p50_ms, s.p75_ms, s.p95_ms, s.p98_ms, s.p99_ms, s.p999_ms)):
        assert abs(v - np.quantile(newest, q)) < 1e-6


def test_stream_stats_equal_batch_over_newest_n(spark):
    from riverbend.streaming.latency import lag_stats_stream
    from riverbend.streaming.sinks import new_output, parquet_batch_writer
    from riverbend.streaming.state import run_available

    rng = np.random.default_rng(9)
    lags = rng.integers(0, 9000, 900)
    rows = [(i, int(v)) for i, v in enumerate(lags)]
    src = new_output(spark, "lagsrc")
    for lo, hi in ((0, 300), (300, 650), (650, 900)):
        spark.createDataFrame(rows[lo:hi], "arrival long, lag_ms long").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("arrival long, lag_ms long").option("maxFilesPerTrigger", 1).parquet(src)
    out = new_output(spark, "lagstats")
    run_available(lag_stats_stream(stream, "lag_ms", "arrival", 250, new_output(spark, "lagck"),
                                   new_output(spark, "lagstate"), parquet_batch_writer(out)))
    last = spark.read.parquet(out).orderBy(F.col("batch_id").desc()).first()
    want = latency.lag_stats(spark.createDataFrame(rows, "arrival long, lag_ms long"), "lag_ms", "arrival", 250).first()
    assert last.batch_id == 2
    for f in ("n", "min_ms", "max_ms", "mean_ms", "p50_ms", "p99_ms", "p999_ms"):
        assert abs(last[f] - want[f]) < 1e-6, f
