"""Event-time order, sessions and combined watermarks on streams, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riverbend.operators import prefix, routing, windows
from riverbend.streaming import sinks
from riverbend.streaming.eventtime import ordered_stream
from riverbend.streaming.sessions import session_stream
from riverbend.streaming.state import run_available

BASE = dt.datetime(2024, 1, 1)
FAR = (-1, "end", dt.datetime(2100, 1, 1))
SCHEMA = "id long, user string, ts timestamp"


@pytest.fixture(autouse=True)
def small(spark, monkeypatch):
    """Buckets of eight rows; few partitions, for speed."""
    monkeypatch.setattr(prefix, "BUCKET_BITS", 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def _run(spark, batches, start, schema=SCHEMA):
    src, out, ck, state = (sinks.new_output(spark, f"et-{x}") for x in "abcd")
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(src)
        run_available(start(spark.readStream.schema(schema).parquet(src), ck, state, sinks.parquet_batch_writer(out)))
    return spark.read.parquet(out).drop("batch_id").collect()


@pytest.mark.parametrize("n", [1, 4])
def test_order_and_positions(spark, n):
    rnd = random.Random(n)
    rows = [(k, rnd.choice(["hot", "hot", "a", None]), _at(k // 2 * 10 + rnd.choice([0, 0, 25]))) for k in range(120)]
    cut = [rows[k * 120 // n:(k + 1) * 120 // n] for k in range(n)]
    cut[-1] = cut[-1] + [FAR, (500, "a", None)]
    got = _run(spark, cut, lambda s, ck, state, write: ordered_stream(s, "user", "ts", ["id"], ck, state, write, delay_seconds=30))
    want, seen = [], {}
    for i, u, t in sorted(rows, key=lambda r: (r[2], r[0])):
        seen[u] = seen.get(u, 0) + 1
        want.append((i, u, t, seen[u]))
    assert sorted(((r.id, r.user, r.ts, r.position) for r in got), key=repr) == sorted(want, key=repr)


def test_rows_behind_the_watermark_have_no_position(spark):
    batches = [[(1, "a", _at(100))], [(2, "a", _at(50)), (3, "a", _at(95)), (4, "a", _at(200))], [FAR]]
    got = _run(spark, batches, lambda s, ck, state, write: ordered_stream(s, "user", "ts", ["id"], ck, state, write, delay_seconds=10))
    assert sorted((r.position, r.id) for r in got) == [(1, 3), (2, 1), (3, 4)]


@pytest.mark.parametrize("n", [1, 3])
def test_sessions_merge_over_batches(spark, n):
    """Rows come in any order; late ones bridge sessions that stood apart."""
    rnd = random.Random(20 + n)
    rows = [(k, rnd.choice(["hot"] * 4 + ["a", "b", None]), _at(rnd.randrange(1500))) for k in range(150)]
    cut = [rows[k * 150 // n:(k + 1) * 150 // n] for k in range(n)]
    cut[-1] = cut[-1] + [FAR, (500, "a", None)]
    got = _run(spark, cut, lambda s, ck, state, write: session_stream(s, "user", "ts", 20, ck, state, write, delay_seconds=2000))
    want = windows.sessionize(spark.createDataFrame(rows, SCHEMA), "user", "ts", 20).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr) and len(want) > 10


def test_a_late_row_bridges_two_sessions_and_closed_ones_stay(spark):
    batches = [[(1, "a", _at(0)), (2, "a", _at(30))], [(3, "a", _at(15)), (4, "a", _at(60))], [(5, "a", _at(10)), (6, "a", _at(500))], [FAR]]
    got = _run(spark, batches, lambda s, ck, state, write: session_stream(s, "user", "ts", 20, ck, state, write, delay_seconds=25))
    # row 5 is behind the watermark of 35; the first session closes when the watermark is past 50
    assert sorted((r.activity_start, r.activity_end, r.num_interactions) for r in got) == [
        (_at(0), _at(30), 3), (_at(60), _at(60), 1), (_at(500), _at(500), 1)]


def _combined(rows, partitions, idle_ms):
    """Late ids by the definition, row by row."""
    newest, came, late, first = {}, {}, set(), None
    for i, p, t, a in rows:
        if first is not None:
            active = [q for q in partitions if a - came.get(q, first) <= idle_ms]
            if active and all(q in newest for q in active) and t < min(newest[q] for q in active) - 1:
                late.add(i)
        first = a if first is None else first
        newest[p], came[p] = max(newest.get(p, t), t), a
    return late


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_watermark_over_partitions_with_idleness(spark, seed):
    rnd, a, rows = random.Random(seed), 0, []
    for k in range(200):
        a += rnd.choice([0, 10, 100, 100, 3000 if k % 50 == 49 else 10])
        rows.append((k, rnd.choice([0] * 6 + [1, 2] + ([3] if k < 60 else [])), 1_000_000 + a + rnd.choice([0, -50, -400, -5000]), a))
    stamp = lambda ms: BASE + dt.timedelta(milliseconds=ms)
    df = spark.createDataFrame([(i, p, stamp(t), stamp(x)) for i, p, t, x in rows], "id long, part int, ts timestamp, came timestamp").repartition(3)
    tagged = routing.tag_late_combined(df, "ts", "id", "part", range(5 if seed == 3 else 4), "came", 1500)
    assert tagged.columns == [*df.columns, "__late"] and tagged.count() == 200
    want = _combined(rows, range(5 if seed == 3 else 4), 1500)
    assert {r.id for r in tagged.filter("__late").collect()} == want and want


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id long, part int, ts timestamp, came timestamp")
    assert routing.tag_late_combined(none, "ts", "id", "part", range(3), "came", 10).count() == 0
    two = prefix.bucketed_prefixes(spark.createDataFrame([(1, 5), (2, 3), (3, 9)], "i int, v int").withColumn("k", F.lit(1)), ["k"], [F.col("i")],
                                   {"top": F.col("v"), "low": -F.col("v")}, kind="max", inclusive=True)
    assert sorted((r.i, r.top, -r.low) for r in two.collect()) == [(1, 5, 5), (2, 5, 3), (3, 9, 3)]
