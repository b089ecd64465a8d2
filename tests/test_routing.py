"""Split by value, dead letters (note D rules), late rows (batch and stream)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.operators import prefix, routing
from riverbend.plans import derive
from riverbend.sources.tables import read_table
from riverbend.streaming.late import split_late_stream
from riverbend.streaming.sinks import new_output, parquet_batch_writer
from riverbend.streaming.state import run_available

from conftest import SF_SMALL

EVENT = T.StructType([T.StructField("id", T.LongType()), T.StructField("data", T.StringType()),
                      T.StructField("timestamp", T.TimestampType())])


def test_split_by_priority_golden(spark):
    # G5
    df = spark.createDataFrame([(1, "some critical event", "CRITICAL"), (2, "some major event", "MAJOR"),
                                (3, "some minor event", "MINOR")], "id long, data string, priority string")
    outs = routing.split_by(df, "priority", {"CRITICAL": "critical", "MAJOR": "major", "MINOR": "minor"})
    assert [r.id for r in outs["critical"].collect()] == [1]
    assert [r.id for r in outs["major"].collect()] == [2]
    assert set(outs) == {"critical", "major", "minor"}


def _split(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    good, bad = routing.dead_letter_split(df, "value", EVENT, ["id", "data", "timestamp"], time_fields=["timestamp"])
    return good.collect(), [r.value for r in bad.collect()]


def test_dead_letter_every_tenth_missing_id(spark):
    # G9: 100 rows, every 10th lacks id -> 90 good, 10 bad
    vals = []
    for i in range(1, 101):
        body = f'"data": "d{i}", "timestamp": 1658419083.146222000'
        vals.append("{" + body + "}" if i % 10 == 0 else "{" + f'"id": {i}, ' + body + "}")
    good, bad = _split(spark, vals)
    assert len(good) == 90 and len(bad) == 10
    assert good[0].timestamp == dt.datetime(2022, 7, 21, 15, 58, 3, 146222)


def test_dead_letter_note_d_cases(spark):
    ok = '{"id": 1, "data": "x", "timestamp": "2022-07-21T15:58:03.146Z"}'
    cases_bad = ["not json", '{"data": "x", "timestamp": 1}', '{"id": 1, "data": "x", "timestamp": 1, "more": 2}',
                 "", '{"id": "x", "data": "x", "timestamp": 1}', '{"id": 1.5, "data": "x", "timestamp": 1}',
                 '[1, 2]', '{"id": 1, "data": "x", "timestamp": "yesterday"}', None]
    cases_good = [ok, '{"id": null, "data": "x", "timestamp": 1}']
    good, bad = _split(spark, cases_bad + cases_good)
    assert sorted(bad, key=str) == sorted(cases_bad, key=str)
    assert sorted((r.id, r.data) for r in good if r.id is not None) == [(1, "x")]
    assert len(good) == 2


def test_late_rows_golden(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_BITS", 4)  # many buckets
    # G8: ids from 1; id > 50 and id % 10 == 0 -> "delayed", 5 h in the past
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1, 301):
        late = i > 50 and i % 10 == 0
        rows.append((i, "delayed" if late else "x", t0 + dt.timedelta(seconds=i) - dt.timedelta(hours=5 if late else 0)))
    df = spark.createDataFrame(rows, "id long, data string, ts timestamp")
    main, late = routing.split_late(df, "ts", "id")
    main_rows = main.orderBy("id").collect()
    late_rows = late.orderBy("id").collect()
    assert all(r.data != "delayed" for r in main_rows[:100])
    assert [r.data for r in late_rows[:10]] == ["delayed"] * 10
    assert len(main_rows) + len(late_rows) == 300


def test_late_split_one_ms_tolerance(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(0, t0 + dt.timedelta(milliseconds=10)), (1, t0 + dt.timedelta(milliseconds=9)),
            (2, t0 + dt.timedelta(milliseconds=8))]
    df = spark.createDataFrame(rows, "o long, ts timestamp")
    main, late = routing.split_late(df, "ts", "o")
    assert sorted(r.o for r in late.collect()) == [2]


def test_late_stream_equals_batch(spark):
    ev = read_table(spark, SF_SMALL, "events", ["event_id", "event_type", "ts"])
    le = derive.late_events(ev).withColumn("part", (F.col("offset") % 2).cast("int"))
    main_b, late_b = routing.split_late(le, "event_time", "offset", "part")
    src = new_output(spark, "late-src")
    for lo, hi in ((0, 300), (300, 700), (700, 10**9)):
        le.filter((F.col("offset") >= lo) & (F.col("offset") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(le.schema).option("maxFilesPerTrigger", 1).parquet(src)
    on_dir, late_dir = new_output(spark, "late-on"), new_output(spark, "late-late")
    q = split_late_stream(stream, "event_time", "offset", "part", parquet_batch_writer(on_dir),
                          parquet_batch_writer(late_dir), new_output(spark, "late-ck"),
                          new_output(spark, "late-state"))
    run_available(q)
    cols = ["id", "data", "event_time", "offset", "part"]
    got_main = {tuple(r) for r in spark.read.parquet(on_dir).select(*cols).collect()}
    got_late = {tuple(r) for r in spark.read.parquet(late_dir).select(*cols).collect()}
    assert got_late == {tuple(r) for r in late_b.select(*cols).collect()}
    assert got_main == {tuple(r) for r in main_b.select(*cols).collect()}
    assert len(got_late) > 0
