"""Keyed state: latest per key, reading it back, migrating and re-seeding it,
and the streaming form of latest improvements."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

import pytest

from riverbend.operators import dedup, prefix
from riverbend.sources.tables import read_table
from riverbend.streaming import state
from riverbend.streaming.sinks import new_output, parquet_batch_writer

from conftest import SF_SMALL

SUB1 = T.ArrayType(T.StructType([T.StructField("content1", T.StringType()), T.StructField("content2", T.StringType())]))
VALUE = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("sub_events", SUB1)])
ROWS = T.StructType([T.StructField("userId", T.LongType())] + VALUE.fields)


def test_state_read_migrate_reseed(spark):
    # G14: users 0 and 1, one sub-event per row
    src = new_output(spark, "g14")
    rows = [(i % 2, i, [(f"c1-{i}", f"c2-{i}")]) for i in range(20)]
    spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(src)
    ck = new_output(spark, "g14-ck")
    state.keyed_latest_stream(spark.readStream.schema(ROWS).parquet(src), "userId", VALUE, "event_id", ck)
    st = state.read_state(spark, ck).orderBy("userId").collect()
    assert [(r.userId, r.event_id) for r in st] == [(0, 18), (1, 19)]
    assert st[0].sub_events[0].content2 == "c2-18"

    value2 = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("sub_events", T.ArrayType(T.StructType([T.StructField("content1", T.StringType())])))])
    seed = state.migrate_state(spark, ck, lambda s: s.select(
        "userId", "event_id", F.transform("sub_events", lambda e: F.struct(e["content1"].alias("content1"))).alias("sub_events")))
    src2 = new_output(spark, "g14-2")
    spark.createDataFrame([(0, 7, [("late",)])], "userId long, event_id long, sub_events array<struct<content1:string>>") \
        .write.parquet(src2)
    ck2 = new_output(spark, "g14-ck2")
    schema2 = T.StructType([T.StructField("userId", T.LongType())] + value2.fields)
    state.keyed_latest_stream(spark.readStream.schema(schema2).parquet(src2), "userId", value2, "event_id", ck2, seed=seed)
    st2 = state.read_state(spark, ck2).orderBy("userId").collect()
    # the older event 7 does not replace the migrated event 18; user 1 carried over
    assert [(r.userId, r.event_id, r.sub_events[0].content1) for r in st2] == [(0, 18, "c1-18"), (1, 19, "c1-19")]


def test_state_keeps_large_ids_string_keys_and_null_arrivals(spark):
    value = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("at", T.LongType())])
    schema = T.StructType([T.StructField("k", T.StringType())] + value.fields)
    big = 2 ** 53 + 1
    src, ck = new_output(spark, "big"), new_output(spark, "big-ck")
    spark.createDataFrame([("a", big, 1.5, 1), ("a", 3, None, None), (None, big + 2, 0.5, 4)], schema).write.parquet(src)
    state.keyed_latest_stream(spark.readStream.schema(schema).parquet(src), "k", value, "at", ck)
    assert {tuple(r) for r in state.read_state(spark, ck).collect()} == {("a", big, 1.5, 1), (None, big + 2, 0.5, 4)}


@pytest.mark.parametrize("bits", [2, 20])
def test_latest_improvements_stream_equals_batch(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix, "BUCKET_BITS", bits)
    ev = read_table(spark, SF_SMALL, "events", ["event_id", "user_id", "ts"])
    ev = ev.withColumn("arrival", ((F.col("event_id") * 7919) % 100003) * 1_000_000 + F.col("event_id"))
    batch = {r.event_id for r in dedup.latest_improvements(ev, "user_id", "ts", "arrival").collect()}
    src = new_output(spark, "li-src")
    for lo, hi in ((0, 40000), (40000, 80000), (80000, 10**9)):  # three arrival slices, in order
        ev.filter((F.col("arrival") >= lo * 1_000_000) & (F.col("arrival") < hi * 1_000_000)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = new_output(spark, "li-out")
    state.run_available(state.latest_improvements_stream(
        stream, "user_id", "ts", "arrival", new_output(spark, "li-ck"), new_output(spark, "li-carry"), parquet_batch_writer(out)))
    assert {r.event_id for r in spark.read.parquet(out).collect()} == batch


def test_keep_first_with_state_ttl(spark):
    import datetime as dt

    schema = "t_id long, t_time timestamp, copy int"
    base = dt.datetime(2022, 1, 1)
    results = {}
    for ttl in (1, 3_600_000):
        src = new_output(spark, "ttl-src")
        for rows in ([(1, base, 0), (1, base, 1), (2, base, 0)], [(1, base, 2)]):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        out, ck = new_output(spark, "ttl-out"), new_output(spark, "ttl-ck")
        q = (state.keep_first_ttl_stream(stream, "t_id", ["t_time", "copy"], ttl)
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .outputMode("append").trigger(processingTime="200 milliseconds").start())
        # ProcessingTime mode keeps running state-cleanup batches, so the query
        # never goes idle: wait until every input row has been consumed
        import time
        try:
            deadline = time.time() + 120
            while time.time() < deadline:
                consumed = sum(p["numInputRows"] for p in q.recentProgress)
                if consumed >= 4 and q.lastProgress and q.lastProgress["numInputRows"] == 0:
                    break
                time.sleep(0.5)
        finally:
            q.stop()
        results[ttl] = sorted((r.t_id, r.copy) for r in spark.read.parquet(out).collect())
    assert results[3_600_000] == [(1, 0), (2, 0)]          # the repeat of key 1 is dropped
    assert results[1] == [(1, 0), (1, 2), (2, 0)]          # expired mark: key 1 emitted again


def test_initial_state_is_not_input(spark):
    """Keys that the stream doesn't bring keep their initial state; a newer row wins, an older one doesn't."""
    import pandas as pd  # noqa: F401

    from riverbend.streaming import sinks, state

    value = T.StructType([T.StructField("seq", T.LongType()), T.StructField("text", T.StringType()), T.StructField("x", T.DoubleType())])
    schema = "key long, seq long, text string, x double"
    initial = spark.createDataFrame([(1, 10, "old one", 0.5), (2, 10, "kept", None), (3, 10, "newer than the stream", 1.5)], schema)
    src, ck = sinks.new_output(spark, "init-src"), sinks.new_output(spark, "init-ck")
    rows = [(1, 11, "new one", 2.5), (1, 12, "newest", None), (3, 9, "late", 3.5), (4, 1, "own", 4.5)] + [(5, k, f"hot {k}", 0.0) for k in range(500)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(src)
    stream = lambda: spark.readStream.schema(schema).parquet(src)
    state.keyed_latest_from(stream(), "key", value, "seq", ck, initial=initial)
    read = lambda: sorted(((r.key, r.seq, r.text, r.x) for r in state.read_variable(spark, ck, "latest", "key").collect()), key=repr)
    want = [(1, 12, "newest", None), (2, 10, "kept", None), (3, 10, "newer than the stream", 1.5), (4, 1, "own", 4.5), (5, 499, "hot 499", 0.0)]
    assert read() == sorted(want, key=repr)
    spark.createDataFrame([(2, 20, "moved", 9.0)], schema).write.mode("append").parquet(src)
    state.keyed_latest_from(stream(), "key", value, "seq", ck, initial=initial)
    assert (2, 20, "moved", 9.0) in read() and len(read()) == 5
    names = [r.operatorName for r in state.state_variables(spark, ck).collect()]
    assert names and all("transformWithState" in n for n in names)
