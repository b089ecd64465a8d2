"""Hot-sensor patterns: golden generator cases and a brute-force fold."""

import datetime as dt
import random

import pytest

from riverbend.operators import patterns, prefix

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


def _df(spark, temps, step_ms=100, device=1, start=0):
    rows = [(start + i, device, BASE + dt.timedelta(milliseconds=step_ms * i), float(t)) for i, t in enumerate(temps)]
    return spark.createDataFrame(rows, "id long, device long, ts timestamp, temp double")


def _run(spark, fn, df, tol):
    return sorted(r.id for r in fn(df, "device", "ts", "temp", "id", 50.0, tol).collect())


def brute(rows, tol_us, version):
    """Sequential reference fold over rows (id, device, ts_us, temp) sorted by (ts, id)."""
    out = []
    by_dev = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_dev.setdefault(r[1], []).append(r)
    for seq in by_dev.values():
        if version == 3:
            i, n = 0, len(seq)
            while i < n:
                if seq[i][3] < 50 and i + 1 < n and seq[i + 1][3] >= 50:
                    first = seq[i + 1]
                    j = i + 2
                    while j < n and seq[j][3] >= 50:
                        if seq[j][2] >= first[2] + tol_us:
                            out.append(seq[j][0])
                            break
                        j += 1
                    i = j
                else:
                    i += 1
            continue
        start = None
        for r in seq:
            hot = r[3] >= 50
            if not hot:
                if version == 2:
                    start = None
                continue
            if start is None:
                start = r
            elif r[2] >= start[2] + tol_us:
                out.append(r[0])
                start = None
    return sorted(out)


@pytest.mark.parametrize("seed,bucketed", [(1, False), (2, True)])
def test_against_brute_force(spark, seed, bucketed, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_BITS", 3 if bucketed else 20)  # buckets of eight rows, or of all
    rnd = random.Random(seed)
    rows, rid = [], 0
    for dev in range(4):
        t = 0
        for _ in range(rnd.randint(10, 40)):
            t += rnd.choice([0, 1, 2, 3]) * 250_000  # 0 s .. 0.75 s steps, with ties
            rows.append((rid, dev, t, float(rnd.choice([30, 49.9, 50, 60, 70]))))
            rid += 1
    df = spark.createDataFrame([(r[0], r[1], BASE + dt.timedelta(microseconds=r[2]), r[3]) for r in rows],
                               "id long, device long, ts timestamp, temp double")
    for tol in ((1.0,) if bucketed else (0.0,)):
        for version, fn in ((1, patterns.hot_v1), (2, patterns.hot_v2), (3, patterns.hot_v3)):
            got = sorted(r.id for r in fn(df, "device", "ts", "temp", "id", 50.0, tol).collect())
            assert got == brute(rows, int(tol * 1_000_000), version), (version, tol)


def test_rising_temperature(spark):
    # G7 row 1: 49, 50, 51 ... for 3 s at 10 rows/s, tolerance 1 s
    df = _df(spark, [49 + i for i in range(30)])
    assert len(_run(spark, patterns.hot_v2, df, 1.0)) > 1
    assert len(_run(spark, patterns.hot_v3, df, 1.0)) == 1


def test_oscillating_3s(spark):
    # G7 row 2: 3 s hot / 3 s cool for 9 s, tolerance 2 s, starting cool
    temps = [40 if (i // 30) % 2 == 0 else 60 for i in range(90)]
    df = _df(spark, temps)
    assert len(_run(spark, patterns.hot_v2, df, 2.0)) >= 1
    assert len(_run(spark, patterns.hot_v3, df, 2.0)) >= 1


def test_oscillating_1s_false_match_only_in_v1(spark):
    # G7 row 3: 1 s hot / 1 s cool for 3 s, tolerance 2 s
    temps = [60 if (i // 10) % 2 == 0 else 40 for i in range(30)]
    df = _df(spark, temps)
    assert len(_run(spark, patterns.hot_v1, df, 2.0)) >= 1
    assert _run(spark, patterns.hot_v2, df, 2.0) == []
    assert _run(spark, patterns.hot_v3, df, 2.0) == []


FAR = (-1, -1, dt.datetime(2100, 1, 1), 0.0)
READING = "id long, device long, ts timestamp, temp double"


def _stream(spark, version, batches, tol, delay=0.0, replay=()):
    """Ids of the alerts when the batches come one after another, each in two files."""
    from riverbend.streaming.patterns import HotMatcher
    from riverbend.streaming.sinks import new_output

    matcher = HotMatcher("device", "ts", "temp", "id", 50.0, tol, version, new_output(spark, "hot-carry"), delay)
    out = []
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, READING).repartition(2)
        found = [r.id for r in matcher.step(df, i).collect()]
        if i in replay:
            assert sorted(r.id for r in matcher.step(df, i).collect()) == sorted(found)
        out += found
    return sorted(out)


def _random_readings(seed, devices=3, most=40):
    rnd, rows = random.Random(seed), []
    for dev in range(devices):
        t = 0
        for _ in range(rnd.randint(5, most)):
            t += rnd.choice([0, 1, 2, 3]) * 250_000
            rows.append((len(rows), dev if dev else None, t, float(rnd.choice([30, 49.9, 50, 60, 70]))))
    return sorted(rows, key=lambda r: (r[2], r[0]))


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _stamped(rows):
    return [(i, d, BASE + dt.timedelta(microseconds=t), temp) for i, d, t, temp in rows]


@pytest.mark.parametrize("version, n", [(1, 1), (1, 3), (1, 20), (2, 1), (2, 3), (3, 1), (3, 3), (3, 20)])
def test_matches_go_on_over_batches(spark, version, n, monkeypatch, few_partitions):
    """Cuts fall inside runs and between readings at one time; a batch may be empty; one is replayed."""
    monkeypatch.setattr(prefix, "BUCKET_BITS", 3)
    rows = _random_readings(version * 10 + n, most=40 if n < 20 else 25)
    cuts = sorted(random.Random(n).randrange(len(rows) + 1) for _ in range(n - 1))
    batches = [_stamped(rows[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    batches[-1].append(FAR)
    assert _stream(spark, version, batches, 1.0, replay=(n // 2,)) == brute([(i, d or 0, t, x) for i, d, t, x in rows], 1_000_000, version)


def test_late_null_and_out_of_order_readings_on_a_stream(spark):
    # readings up to 2 s out of order are put right; one behind the watermark is dropped, NaN and NULL are none
    rows = [(k, 1, k * 500_000, 40.0 if k in (0, 9) else 60.0) for k in range(20)]
    shuffled = [rows[k] for k in (1, 0, 3, 2, 5, 4, 7, 6, 8, 9, 11, 10, 13, 12, 15, 14, 16, 17, 19, 18)]
    batches = [_stamped(shuffled[k:k + 5]) for k in range(0, 20, 5)]
    batches[2] += [(100, 1, None, 60.0), (101, 1, BASE, float("nan")), (102, None, BASE, None), (103, 1, BASE, 10.0)]
    batches[3].append(FAR)
    for version in (1, 2, 3):
        assert _stream(spark, version, batches, 2.0, delay=2.0) == brute(rows, 2_000_000, version), version


def test_a_hot_device_is_not_one_task(spark, monkeypatch):
    """Most readings are one device's; no stage of the windows sees more than a bucket of them."""
    monkeypatch.setattr(prefix, "BUCKET_BITS", 4)
    rows = [(k, 1, k * 100_000, 60.0 if k % 37 else 40.0) for k in range(400)] + [(1000 + k, 2 + k, k * 900_000, 60.0) for k in range(40)]
    rows.sort(key=lambda r: (r[2], r[0]))
    batches = [_stamped(rows[:250]), _stamped(rows[250:]) + [FAR]]
    for version in (1, 2, 3):
        assert _stream(spark, version, batches, 1.0) == brute(rows, 1_000_000, version), version


def test_raw_rows_and_alerts_of_one_read(spark):
    from riverbend.streaming import sinks
    from riverbend.streaming.patterns import HotMatcher
    from riverbend.streaming.state import run_available

    rows = _random_readings(77)
    want = brute([(i, d or 0, t, x) for i, d, t, x in rows], 1_000_000, 3)
    for n in (1, 7):
        src, raw, alerts, ck, carry = (sinks.new_output(spark, f"both-{x}") for x in "abcde")
        matcher = HotMatcher("device", "ts", "temp", "id", 50.0, 1.0, 3, carry)
        size = -(-len(rows) // n)
        for k in range(n):
            spark.createDataFrame(_stamped(rows[k * size:(k + 1) * size]) + [FAR] * (k == n - 1), READING).coalesce(1).write.mode("append").parquet(src)
            stream = spark.readStream.schema(READING).parquet(src)
            write = sinks.parquet_batch_writer(alerts)
            run_available(sinks.fan_out(stream, {"raw": (lambda b: b, sinks.parquet_batch_writer(raw)),
                                                 "alerts": (lambda b: b, lambda b, i: write(matcher.step(b, i), i))}, ck))
        assert sorted(r.id for r in spark.read.schema(READING).parquet(alerts).collect()) == want
        assert spark.read.schema(READING).parquet(raw).count() == len(rows) + 1
