"""Tumbling windows, word counts and sessions (batch and streaming)."""

import datetime as dt

from pyspark.sql import functions as F

from riverbend.operators import prefix, windows
from riverbend.sources.tables import read_table
from riverbend.streaming.sinks import new_output
from riverbend.streaming.state import run_available

from conftest import SF_SMALL

BASE = dt.datetime(2024, 1, 1)


def _ev(spark, secs):
    rows = [("u1" if s < 1000 else "u2", BASE + dt.timedelta(seconds=s)) for s in secs]
    return spark.createDataFrame(rows, "user string, ts timestamp")


def test_session_gap_boundaries(spark):
    # G12: rows exactly 5 s apart merge, 5.001 s apart do not
    df = _ev(spark, [0, 5, 10, 15.001, 1000, 1002])
    out = windows.sessionize(df, "user", "ts", 5).orderBy("user", "activity_start").collect()
    assert [(r.user, r.num_interactions) for r in out] == [("u1", 3), ("u1", 1), ("u2", 2)]
    assert out[0].activity_end == BASE + dt.timedelta(seconds=10)


def test_sessionize_chunking_invariant(spark, monkeypatch):
    ev = read_table(spark, SF_SMALL, "events", ["user_id", "ts"])
    got = []
    for bits in (0, 3, 20):  # chunks of one row, of eight, of all
        monkeypatch.setattr(prefix, "BUCKET_BITS", bits)
        got.append({tuple(r) for r in windows.sessionize(ev, "user_id", "ts", 3 * 3600).collect()})
    assert got[0] == got[1] == got[2]


def test_sessions_stream_equals_batch(spark):
    ev = read_table(spark, SF_SMALL, "events", ["user_id", "ts"])
    batch = {tuple(r) for r in windows.sessionize(ev, "user_id", "ts", 6 * 3600).collect()}
    src = new_output(spark, "sess-src")
    # far-future sentinel closes the last sessions at the end of the bounded input
    sentinel = spark.createDataFrame([(-1, dt.datetime(2100, 1, 1))], "user_id long, ts timestamp")
    # arrival in event-time order: three time-ordered appends, then the sentinel
    bounds = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), dt.datetime(2025, 1, 1)]
    for lo, hi in zip(bounds, bounds[1:]):
        ev.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(src)
    sentinel.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out_dir, ck = new_output(spark, "sess-out"), new_output(spark, "sess-ck")
    q = (windows.session_activity_stream(stream, "user_id", "ts", "6 hours").writeStream.format("parquet")
         .option("path", out_dir).option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start())
    run_available(q)
    got = {tuple(r) for r in spark.read.parquet(out_dir).filter("user_id >= 0").collect()}
    assert got == batch


def test_tumbling_counts_epoch_aligned(spark):
    df = _ev(spark, [0, 4.9, 5, 12])
    out = windows.tumbling_counts(df, "ts", "5 seconds").orderBy("window_start").collect()
    assert [(r.window_start, r.cnt) for r in out] == [
        (BASE, 2), (BASE + dt.timedelta(seconds=5), 1), (BASE + dt.timedelta(seconds=10), 1)]


def test_word_count_tokenizes_whole_text(spark):
    df = spark.createDataFrame([("Hello, hello WORLD! été_x",), ("",), (None,)], "text string")
    got = {(r.word, r["count"]) for r in windows.word_count(df, "text").collect()}
    assert got == {("hello", 2), ("world", 1), ("t", 1), ("_x", 1)}


def test_windowed_word_count(spark):
    rows = [("a b a", BASE), ("a", BASE + dt.timedelta(seconds=6))]
    df = spark.createDataFrame(rows, "line string, ts timestamp")
    got = {(r.window_start, r.word, r["count"]) for r in windows.windowed_word_count(df, "line", "ts", "5 seconds").collect()}
    assert got == {(BASE, "a", 2), (BASE, "b", 1), (BASE + dt.timedelta(seconds=5), "a", 1)}
