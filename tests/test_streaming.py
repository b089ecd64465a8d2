"""Streaming forms: keep-latest (update mode), keep-first within watermark,
windowed counts with a watermark, deduplicated stream join, lag metrics,
metrics."""

import datetime as dt

from pyspark.sql import functions as F

from riverbend.operators import dedup, latency, windows
from riverbend.streaming import sinks
from riverbend.streaming.state import run_available

BASE = dt.datetime(2024, 1, 1)


def _stage(spark, name, batches, schema):
    path = sinks.new_output(spark, name)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def _memory(df, mode, name):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    run_available(q)
    return df.sparkSession.table(name)


def test_keep_latest_stream_update_mode(spark):
    schema = "t_customer_id long, t_id long, t_time timestamp"
    s = _stage(spark, "kl", [[(0, 0, BASE), (1, 1, BASE)], [(0, 2, BASE + dt.timedelta(days=5)), (1, 3, BASE)]], schema)
    out = _memory(dedup.keep_latest(s, "t_customer_id", ["t_time", "t_id"]), "complete", "kl_out")
    assert sorted((r.t_customer_id, r.t_id) for r in out.collect()) == [(0, 2), (1, 3)]


def test_keep_first_stream_within_watermark(spark):
    schema = "t_id long, t_time timestamp, copy int"
    s = _stage(spark, "kf", [[(1, BASE, 0), (2, BASE, 0)], [(1, BASE, 1), (3, BASE, 0)]], schema)
    out = _memory(dedup.keep_first_stream(s, "t_id", "t_time", "1 hour"), "append", "kf_out")
    assert sorted((r.t_id, r.copy) for r in out.collect()) == [(1, 0), (2, 0), (3, 0)]


def test_tumbling_counts_stream_closes_windows(spark):
    schema = "ts timestamp, word string"
    batches = [[(BASE + dt.timedelta(seconds=s), "a") for s in (0, 1, 6)], [(BASE + dt.timedelta(seconds=100), "a")]]
    s = _stage(spark, "tc", batches, schema).withWatermark("ts", "0 seconds")
    out = _memory(windows.tumbling_counts(s, "ts", "5 seconds", "word"), "append", "tc_out")
    assert sorted((r.window_start, r.cnt) for r in out.collect()) == [(BASE, 2), (BASE + dt.timedelta(seconds=5), 1)]


def test_dedup_join_stream(spark):
    cust = _stage(spark, "dj-c", [[(12, "Alice", BASE), (7, "Carol", BASE)]], "c_id long, c_name string, c_time timestamp")
    tx = _stage(spark, "dj-t", [[(1, 12, BASE), (2, 7, BASE), (2, 7, BASE)]], "t_id long, t_customer_id long, t_time timestamp")
    j = dedup.dedup_join_stream(cust, tx, "c_id", "t_customer_id", "c_time", "t_time", "1 hour", "1 day",
                                [F.col("t_id"), F.col("c_name")])
    out = _memory(j, "append", "dj_out")
    assert sorted((r.t_id, r.c_name) for r in out.collect()) == [(1, "Alice"), (2, "Carol")]


def test_observed_lag_metrics(spark):
    listener = latency.LagMetrics()
    spark.streams.addListener(listener)
    try:
        s = _stage(spark, "lag", [[(i, BASE) for i in range(10)]], "id long, ts timestamp")
        with_lag = latency.with_lag(s, "ts", F.lit(BASE + dt.timedelta(seconds=2)))
        q = sinks.discard(latency.observe_lag(with_lag, "lag_ms"), sinks.new_output(spark, "lag-ck"))
        run_available(q)
        q.awaitTermination()
        import time
        for _ in range(50):
            if listener.reports:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.reports and listener.reports[0]["rows"] == 10 and listener.reports[0]["max_lag_ms"] == 2000


def test_dead_letters_on_a_stream_with_fan_out(spark):
    from pyspark.sql import types as T

    from riverbend.operators import routing

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("data", T.StringType()),
                           T.StructField("timestamp", T.TimestampType())])
    vals = [('{"id": %d, "data": "d", "timestamp": 1658419083.5}' % i) if i % 4 else "oops %d" % i for i in range(40)]
    s = _stage(spark, "dl", [[(v,) for v in vals[:20]], [(v,) for v in vals[20:]]], "value string")
    good_dir, bad_dir = sinks.new_output(spark, "dl-good"), sinks.new_output(spark, "dl-bad")
    q = sinks.fan_out(s, {
        "good": (lambda b: routing.dead_letter_split(b, "value", schema, ["id", "data", "timestamp"],
                                                     time_fields=["timestamp"])[0], sinks.parquet_batch_writer(good_dir)),
        "bad": (lambda b: routing.dead_letter_split(b, "value", schema, ["id", "data", "timestamp"],
                                                    time_fields=["timestamp"])[1], sinks.parquet_batch_writer(bad_dir)),
    }, sinks.new_output(spark, "dl-ck"))
    run_available(q)
    assert spark.read.parquet(good_dir).count() == 30
    assert sorted(r.value for r in spark.read.parquet(bad_dir).collect()) == sorted(v for v in vals if v.startswith("oops"))


def test_sessions_random_against_sequential(spark, monkeypatch):
    import random

    from riverbend.operators import prefix

    rnd = random.Random(5)
    rows = []
    for u in range(5):
        t = 0.0
        for _ in range(rnd.randint(1, 60)):
            t += rnd.choice([0.5, 1, 3, 5, 5.0005, 8, 30])
            rows.append((u, BASE + dt.timedelta(seconds=t)))
    df = spark.createDataFrame(rows, "u long, ts timestamp")
    want = []
    for u in range(5):
        ts = sorted(t for k, t in rows if k == u)
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if (t - prev).total_seconds() > 5:
                want.append((u, start, prev, n))
                start, n = t, 0
            prev = t
            n += 1
        want.append((u, start, prev, n))
    for bits in (0, 2, 20):
        monkeypatch.setattr(prefix, "BUCKET_BITS", bits)
        got = sorted(tuple(r) for r in windows.sessionize(df, "u", "ts", 5).collect())
        assert got == sorted(want), bits


def test_word_count_on_kafka_records_with_broker_time_watermark(spark):
    from riverbend.sources import kafka

    def rec(i, text, sec):
        return (None, text.encode(), "lines", 0, i, BASE + dt.timedelta(seconds=sec), 0, [])

    batches = [[rec(0, "To be, or not", 0), rec(1, "to BE", 1)], [rec(2, "be quick", 6)], [rec(3, "end", 100)]]
    path = sinks.new_output(spark, "wc-src")
    for b in batches:
        spark.createDataFrame(b, kafka.ENVELOPE).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(kafka.ENVELOPE).option("maxFilesPerTrigger", 1).parquet(path)
    lines = kafka.value_text(stream).withWatermark("timestamp", "0 seconds")
    out = _memory(windows.windowed_word_count(lines, "value", "timestamp", "5 seconds"), "append", "wc_out")
    got = {(r.window_start, r.word, r["count"]) for r in out.collect()}
    assert got == {(BASE, "to", 2), (BASE, "be", 2), (BASE, "or", 1), (BASE, "not", 1),
                   (BASE + dt.timedelta(seconds=5), "be", 1), (BASE + dt.timedelta(seconds=5), "quick", 1)}
