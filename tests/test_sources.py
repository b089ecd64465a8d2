"""Kafka envelopes and headers, change feeds, protobuf, JSON parse failures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.plans.derive import change_feed
from riverbend.sources import cdc, kafka, protobuf


def _envelope(spark, rows):
    return spark.createDataFrame(rows, kafka.ENVELOPE)


def test_headers_last_wins_and_missing_is_null(spark):
    # G10 headers plus a repeated and a missing one
    ts = dt.datetime(2024, 1, 1, 0, 0, 1, 234000)
    h1 = [("tracestate", b"rb=abcdefghijk"), ("traceparent", b"00-a-b-01"), ("traceparent", b"00-c-d-01")]
    rows = [(b"k", b'{"id": 1, "data": "x", "timestamp": 1}', "t", 3, 42, ts, 1, h1),
            (b"k", b'{"id": 2, "data": "y", "timestamp": 2}', "t", 3, 43, ts, 0, [])]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("data", T.StringType()),
                           T.StructField("timestamp", T.StringType())])
    out = kafka.enrich(_envelope(spark, rows), schema, ["tracestate", "traceparent"]).orderBy("event.id").collect()
    assert out[0].headers.traceparent == "00-c-d-01"
    assert out[0].headers.tracestate == "rb=abcdefghijk"
    assert out[1].headers.tracestate is None
    m = out[0].metadata
    assert (m.metadataTopic, m.metadataPartition, m.metadataOffset, m.metadataTimestampType) == ("t", 3, 42, "LogAppendTime")
    assert m.metadataTimestamp == 1704067201234


def test_parse_value_fail_fast(spark):
    rows = [(None, b"{not json", "t", 0, 0, dt.datetime(2024, 1, 1), 0, [])]
    schema = T.StructType([T.StructField("id", T.LongType())])
    with pytest.raises(Exception):
        kafka.parse_value(_envelope(spark, rows), schema, fail_on_error=True).collect()
    assert kafka.parse_value(_envelope(spark, rows), schema, fail_on_error=False).count() == 1
    for value, good in ((b'{"id": 1}', True), (b'{"id": null}', True), (b"{}", False), (b'{"id": 1, "x": 2}', False),
                        (b'{"id": "a"}', False), (b"", False), (None, False)):
        one = kafka.parse_value(_envelope(spark, [(None, value, "t", 0, 0, dt.datetime(2024, 1, 1), 0, [])]), schema)
        if good:
            assert one.count() == 1 and one.collect()
        else:
            with pytest.raises(Exception, match="does not map"):
                one.collect()


def test_bad_change_events_are_kept_apart(spark):
    good = '{"op": "c", "before": null, "after": {"t_id": 1, "t_customer_id": 2, "t_amount": 3.5}, "ts_ms": 5, "source": {"lsn": 1}}'
    bad = ["garbage", '{"op": "c", "after": {"t_id": "x"}}', '{"op": "z", "after": {"t_id": 1}}', '{"op": "u"}', "", None]
    df = spark.createDataFrame([(v, k) for k, v in enumerate([good, *bad])], "value string, n int")
    changes, apart = cdc.split_cdc(df, "value", ROW)
    assert [r.after.t_id for r in changes.collect()] == [1]
    assert sorted(r.n for r in apart.collect()) == [1, 2, 3, 4, 5, 6] and apart.columns == df.columns
    for v in bad:
        with pytest.raises(Exception):
            cdc.apply_cdc(cdc.parse_cdc(spark.createDataFrame([(v,)], "value string"), "value", ROW), "t_id").collect()


ROW = T.StructType([T.StructField("t_id", T.LongType()), T.StructField("t_customer_id", T.LongType()),
                    T.StructField("t_amount", T.DecimalType(10, 2))])


def test_cdc_inserts_golden(spark):
    # G4: five inserts, same five after-images in order
    ins = [(1, 24, "99.08"), (2, 7, "405.01"), (3, 24, "974.90"), (4, 8, "100.19"), (5, 24, "161.48")]
    vals = [(f'{{"before": null, "after": {{"t_id": {a}, "t_customer_id": {b}, "t_amount": {c}}}, '
             f'"op": "c", "ts_ms": {1000 + a}, "source": {{"lsn": {a}}}}}',) for a, b, c in ins]
    changes = cdc.parse_cdc(spark.createDataFrame(vals, "value string"), "value", ROW)
    got = [tuple(r) for r in cdc.after_images(changes).orderBy("t_id").collect()]
    assert got == [(a, b, Decimal(c)) for a, b, c in ins]
    assert cdc.apply_cdc(changes, "t_id").count() == 5


def test_cdc_updates_and_deletes(spark):
    orders = spark.createDataFrame(
        [(k, k % 3, 100.0 + k, dt.datetime(2024, 1, 1) + dt.timedelta(days=k)) for k in range(30)],
        "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp")
    current = cdc.apply_cdc(cdc.parse_cdc(change_feed(orders), "value", ROW), "t_id")
    got = {r.t_id: r.t_amount for r in current.collect()}
    assert 6 not in got and 19 not in got          # deleted (k % 13 == 6)
    assert got[4] == Decimal("105.00")             # updated (k % 5 == 4): 104 + 1
    assert got[5] == Decimal("105.00")
    assert len(got) == 28


def test_protobuf_roundtrip_with_unset_fields(spark):
    rows = [("2024-01-01T00:00:00.000Z", 1, 2, 3.5), (None, 2, None, None), ("x", None, 7, -1.25)]
    df = spark.createDataFrame(rows, "t_time string, t_id long, t_customer_id long, t_amount double")
    enc = protobuf.encode(df, "Transaction", protobuf.TRANSACTION_FIELDS)
    dec = protobuf.decode(enc, "value", "Transaction", protobuf.TRANSACTION_FIELDS)
    assert sorted(map(tuple, dec.collect()), key=str) == sorted(rows, key=str)


def test_protobuf_wire_is_standard(spark):
    # field 2 (t_id) varint 150 -> bytes 0x10 0x96 0x01
    df = spark.createDataFrame([(bytearray(b"\x10\x96\x01"),)], "value binary")
    out = protobuf.decode(df, "value", "Transaction", protobuf.TRANSACTION_FIELDS).first()
    assert out.t_id == 150 and out.t_time is None and out.t_amount is None


def test_cdc_stream_equals_batch(spark):
    from riverbend.streaming.sinks import new_output
    from riverbend.streaming.state import run_available

    orders = spark.createDataFrame(
        [(k, k % 3, 100.0 + k, dt.datetime(2024, 1, 1) + dt.timedelta(days=k)) for k in range(40)],
        "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp")
    feed = change_feed(orders)
    src = new_output(spark, "cdc-src")
    rows = [r.value for r in feed.collect()]
    for part in (rows[: len(rows) // 2], rows[len(rows) // 2:]):
        spark.createDataFrame([(v,) for v in part], "value string").coalesce(1).write.mode("append").parquet(src)
    stream = cdc.parse_cdc(spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(src),
                           "value", ROW)
    q = (cdc.apply_cdc_stream(stream, "t_id").writeStream.format("memory").queryName("cdc_stream_out")
         .outputMode("complete").trigger(availableNow=True).start())
    run_available(q)
    final = spark.table("cdc_stream_out").filter(F.col("op") != "d").select("row.*")
    want = cdc.apply_cdc(cdc.parse_cdc(feed, "value", ROW), "t_id")
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, want.collect()))
