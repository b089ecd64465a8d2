"""Deterministic stand-ins for Kafka topics and change feeds, derived from the
driver tables so their size follows the tables.

Fixed derivation rules (the oracle SQL repeats them):
* wire time = decimal epoch seconds with six digits, from ``events.ts``;
* late rows: ``event_id > 50 and event_id % 10 = 0`` -> data "delayed", time 5 h earlier;
* dead letters by ``event_id``: ``% 10 = 9`` no id key, ``% 97 = 13`` extra key,
  ``% 89 = 7`` not JSON, ``% 83 = 5`` empty text, ``% 79 = 3`` id of wrong type;
* partitions: 0 for even ids, else 1 for ``% 3 = 0``, else 3 for ``% 5 = 1`` below half of the ids, else 2; an id comes at
  its number of seconds;
* headers: ``% 11 = 0`` no tracestate, ``% 7 = 0`` a second (winning) traceparent;
* broken change events: for ``o_orderkey % 29 = 3`` a text that is no JSON, for ``% 31 = 4`` a ``t_id`` that is no
  number, for ``% 37 = 5`` an unknown ``op``, each beside the order's own events;
* change feed from orders: insert all, update ``% 5 = 4`` (+1.00), delete ``% 13 = 6``;
* change feed with faults: insert all, update all (+1.00), update ``% 3 = 1`` (+1.00 more), delete ``% 4 = 1``; the first
  update is lost for ``% 7 = 3``, the insert for ``% 17 = 8``, and the first update comes twice for ``% 11 = 5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.sources.cdc import OP_CREATE, OP_DELETE, OP_UPDATE

HOUR_US = 3_600 * 1_000_000


def epoch_text(ts: str) -> Column:
    """``1704067207.179575``: epoch seconds with six decimals, built from integers."""
    us = F.unix_micros(F.col(ts))
    return F.concat(F.expr(f"unix_micros({ts}) div 1000000").cast("string"),
                    F.lit("."), F.lpad((us % F.lit(1_000_000)).cast("string"), 6, "0"))


def event_json(id_text: Column | None, data: Column, ts_text: Column, extra: bool = False) -> Column:
    parts = []
    if id_text is not None:
        parts += [F.lit('{"id": '), id_text, F.lit(", ")]
    else:
        parts += [F.lit("{")]
    parts += [F.lit('"data": "'), data, F.lit('", "timestamp": '), ts_text]
    if extra:
        parts += [F.lit(', "extra": 1')]
    parts += [F.lit("}")]
    return F.concat(*parts)


def late_events(events: DataFrame) -> DataFrame:
    """``id, data, event_time, offset``: every 10th row after the 50th is 5 h behind."""
    late = (F.col("event_id") > 50) & (F.col("event_id") % 10 == 0)
    t = F.when(late, F.timestamp_micros(F.unix_micros("ts") - F.lit(5 * HOUR_US))).otherwise(F.col("ts"))
    return events.select(F.col("event_id").alias("id"),
                         F.when(late, F.lit("delayed")).otherwise(F.col("event_type")).alias("data"),
                         t.alias("event_time"), F.col("event_id").alias("offset"))


def partitioned_arrivals(events: DataFrame) -> DataFrame:
    """:func:`late_events` with the source partition ``part`` and the time ``came`` at which a row arrives."""
    half = events.agg(F.max("event_id")).first()[0] // 2 if events.take(1) else 0
    i = F.col("id")
    part = F.when(i % 2 == 0, 0).when(i % 3 == 0, 1).when((i % 5 == 1) & (i < half), 3).otherwise(2)
    return late_events(events).withColumn("part", part).withColumn("came", F.timestamp_seconds(i))


def dead_letter_messages(events: DataFrame) -> DataFrame:
    """``offset, value``: JSON event texts, some of them broken on purpose."""
    eid = F.col("event_id")
    ts_text = epoch_text("ts")
    good = event_json(eid.cast("string"), F.col("event_type"), ts_text)
    value = (F.when(eid % 10 == 9, event_json(None, F.col("event_type"), ts_text))
              .when(eid % 97 == 13, event_json(eid.cast("string"), F.col("event_type"), ts_text, extra=True))
              .when(eid % 89 == 7, F.concat(F.lit("not json: "), eid.cast("string")))
              .when(eid % 83 == 5, F.lit(""))
              .when(eid % 79 == 3, event_json(F.concat(F.lit('"x'), eid.cast("string"), F.lit('"')),
                                              F.col("event_type"), ts_text))
              .otherwise(good))
    return events.select(eid.alias("offset"), value.alias("value"))


def kafka_envelope(events: DataFrame) -> DataFrame:
    """Events as Kafka records with trace headers."""
    eid = F.col("event_id")
    sid = eid.cast("string")
    h = F.md5(sid)
    tracestate = F.struct(F.lit("tracestate").alias("key"),
                          F.concat(F.lit("rb="), F.substring(h, 1, 11)).cast("binary").alias("value"))
    parent = F.struct(F.lit("traceparent").alias("key"),
                      F.concat(F.lit("00-"), h, F.lit("-"), F.substring(F.md5(F.concat(sid, F.lit("p"))), 1, 16),
                               F.lit("-01")).cast("binary").alias("value"))
    parent2 = F.struct(F.lit("traceparent").alias("key"),
                       F.concat(F.lit("00-"), F.md5(F.concat(sid, F.lit("x"))), F.lit("-"),
                                F.substring(h, 17, 16), F.lit("-01")).cast("binary").alias("value"))
    headers = F.filter(F.array(F.when(eid % 11 != 0, tracestate), parent, F.when(eid % 7 == 0, parent2)),
                       lambda x: x.isNotNull())
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        event_json(sid, F.col("event_type"), epoch_text("ts")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        eid.alias("offset"), F.col("ts").alias("timestamp"), F.lit(0).alias("timestampType"),
        headers.alias("headers"))


def change_feed(orders: DataFrame) -> DataFrame:
    """Debezium-style JSON change events (``value``) for the orders table."""
    k = F.col("o_orderkey")
    amount = F.col("o_totalprice").try_cast("decimal(10,2)")
    row = F.struct(k.alias("t_id"), F.col("o_custkey").alias("t_customer_id"), amount.alias("t_amount"))
    row_upd = F.struct(k.alias("t_id"), F.col("o_custkey").alias("t_customer_id"),
                       (amount + F.lit(1)).try_cast("decimal(10,2)").alias("t_amount"))
    ms = F.unix_millis(F.col("o_orderdate"))

    def event(op, before, after, dt, seq):
        return F.to_json(F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"),
                                  (ms + F.lit(dt)).alias("ts_ms"),
                                  F.struct((k * 3 + F.lit(seq)).alias("lsn")).alias("source")))

    null_row = F.lit(None).cast("struct<t_id:bigint,t_customer_id:bigint,t_amount:decimal(10,2)>")
    changes = F.filter(F.array(
        event(OP_CREATE, null_row, row, 0, 0),
        F.when(k % 5 == 4, event(OP_UPDATE, row, row_upd, 1000, 1)),
        F.when(k % 13 == 6, event(OP_DELETE, F.when(k % 5 == 4, row_upd).otherwise(row), null_row, 2000, 2)),
    ), lambda x: x.isNotNull())
    return orders.select(F.explode(changes).alias("value"))


def change_feed_with_faults(orders: DataFrame) -> DataFrame:
    """A change feed from which events are missing, and in which some come twice."""
    k, amount = F.col("o_orderkey"), F.col("o_totalprice").try_cast("decimal(10,2)")

    def row(more: int) -> Column:
        return F.struct(k.alias("t_id"), F.col("o_custkey").alias("t_customer_id"), (amount + F.lit(more)).try_cast("decimal(10,2)").alias("t_amount"))

    null_row = F.lit(None).cast("struct<t_id:bigint,t_customer_id:bigint,t_amount:decimal(10,2)>")

    def event(when: Column, op: str, before: Column, after: Column, seq: int) -> Column:
        return F.when(when, F.to_json(F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"),
                                               F.unix_millis("o_orderdate").alias("ts_ms"), F.struct((k * 5 + F.lit(seq)).alias("lsn")).alias("source"))))

    final = F.when(k % 3 == 1, row(2)).otherwise(row(1))
    events = F.filter(F.array(
        event(k % 17 != 8, OP_CREATE, null_row, row(0), 0),
        event(k % 7 != 3, OP_UPDATE, row(0), row(1), 1),
        event(k % 11 == 5, OP_UPDATE, row(0), row(1), 2),
        event(k % 3 == 1, OP_UPDATE, row(1), row(2), 3),
        event(k % 4 == 1, OP_DELETE, final, null_row, 4),
    ), lambda x: x.isNotNull())
    return orders.select(F.explode(events).alias("value"))


def change_feed_with_errors(orders: DataFrame) -> DataFrame:
    """The change feed, with broken events among it."""
    k = F.col("o_orderkey")
    text = k.cast("string")
    broken = F.filter(F.array(
        F.when(k % 29 == 3, F.concat(F.lit("oops "), text)),
        F.when(k % 31 == 4, F.concat(F.lit('{"op": "c", "after": {"t_id": "x'), text, F.lit('"}}'))),
        F.when(k % 37 == 5, F.concat(F.lit('{"op": "z", "after": {"t_id": '), text, F.lit("}}"))),
    ), lambda x: x.isNotNull())
    return change_feed(orders).unionByName(orders.select(F.explode(broken).alias("value")))
