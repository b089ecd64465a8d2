"""Changelogs against a plain replay of the arrivals."""

import random

import pytest
from pyspark.sql import functions as F

from riverbend.operators import changelog as C
from riverbend.operators import prefix
from riverbend.streaming import sinks
from riverbend.streaming.changelog import latest_changelog_stream
from riverbend.streaming.state import run_available

SCHEMA = "key string, at long, pos long, op string, v int"


def replay(rows):
    """Changes of the latest row per key by (at), rows taken one by one in the order of pos."""
    state, out = {}, []
    for r in sorted(rows, key=lambda r: r[2]):
        old = state.get(r[0])
        if old is not None and (r[1] is None or old[1] is not None and r[1] <= old[1]):
            continue
        had, has = old is not None and old[3] != "d", r[3] != "d"
        state[r[0]] = r
        if had and has:
            out += [("-U", *old), ("+U", *r)]
        elif has:
            out.append(("+I", *r))
        elif had:
            out.append(("-D", *old))
    return out, [r for r in state.values() if r[3] != "d"]


def _rows(seed, n=300):
    rnd = random.Random(seed)
    return [(rnd.choice(["hot"] * 6 + list("abcdef") + [None]), rnd.choice([None, *range(60)]), k, rnd.choice("iiid"), rnd.randrange(3)) for k in range(n)]


@pytest.mark.parametrize("bits", [2, 20])
def test_log_equals_replay(spark, bits, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_BITS", bits)
    rows = _rows(bits)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    log, carry = C.latest_changelog(df, "key", ["at"], "pos", deleted=F.col("op") == "d")
    want, table = replay(rows)
    got = [tuple(r) for r in log.orderBy("arrival", "step").select("kind", *df.columns).collect()]
    assert got == want
    assert sorted(map(tuple, C.fold_changelog(log, df.columns).collect()), key=repr) == sorted(table, key=repr)
    totals = {r.v: (r.n, r.total) for r in C.retracting_totals(log, "v", "pos").collect()}
    assert totals == {v: (len(x), sum(x)) for v in range(3) if (x := [r[2] for r in table if r[4] == v])}
    assert carry.filter("not gone").count() == len(table)


@pytest.mark.parametrize("n", [1, 4])
def test_stream_equals_replay(spark, n):
    rows = _rows(11 + n)
    src, out, ck, state = (sinks.new_output(spark, f"log-{x}") for x in "abcd")
    df = spark.createDataFrame([], SCHEMA)
    for k in range(n):
        spark.createDataFrame(rows[k * len(rows) // n:(k + 1) * len(rows) // n], SCHEMA).repartition(2).write.mode("append").parquet(src)
        run_available(latest_changelog_stream(spark.readStream.schema(df.schema).parquet(src), "key", ["at"], "pos", ck, state,
                                              sinks.parquet_batch_writer(out), deleted=F.col("op") == "d"))
    got = [tuple(r) for r in spark.read.parquet(out).orderBy("arrival", "step").select("kind", *df.columns).collect()]
    assert got == replay(rows)[0]


def test_what_was_never_entered_cannot_be_taken_back(spark):
    log = spark.createDataFrame([("+I", 1), ("-D", 1), ("-D", 1)], "kind string, v int")
    with pytest.raises(Exception, match="never entered"):
        C.fold_changelog(log, ["v"]).collect()
    twice = spark.createDataFrame([("+I", 1), ("+I", 1), ("-U", 1), ("+U", 2), ("+I", None)], "kind string, v int")
    assert sorted((r.v for r in C.fold_changelog(twice, ["v"]).collect()), key=repr) == [1, 2, None]
    assert C.fold_changelog(twice.limit(0), ["v"]).count() == 0


def test_image_faults(spark):
    e = lambda k, lsn, op, b, a: (op, None if b is None else (k, b), None if a is None else (k, a), lsn)
    events = [e(1, 1, "c", None, 5), e(1, 2, "u", 5, 6), e(1, 3, "d", 6, None), e(1, 9, "c", None, 7),
              e(2, 1, "c", None, 5), e(2, 3, "u", 6, 7), e(2, 4, "u", 6, 7), e(3, 1, "u", 1, 2), e(4, 2, "u", 5, 6), e(4, 1, "c", None, 5)]
    schema = "op string, before struct<id:int,v:int>, after struct<id:int,v:int>, lsn long"
    whole, broken = C.image_breaks(spark.createDataFrame(events, schema), "id")
    assert whole.count() == 7 and whole.columns == ["op", "before", "after", "lsn"]
    got = {(F_.after.id, F_.lsn): (F_.fault, F_.expected and F_.expected.v) for F_ in broken.collect()}
    assert got == {(2, 3): ("gap", 5), (2, 4): ("repeat", 7), (3, 1): ("no_history", None)}
