"""Empty inputs, NULL keys and NULL times across operators."""

import datetime as dt

from pyspark.sql import functions as F

from riverbend.operators import dedup, patterns, routing, windows

BASE = dt.datetime(2024, 1, 1)


def test_empty_inputs(spark):
    ev = spark.createDataFrame([], "id long, device long, ts timestamp, temp double")
    for fn in (patterns.hot_v1, patterns.hot_v2, patterns.hot_v3):
        assert fn(ev, "device", "ts", "temp", "id", 50.0, 1.0).count() == 0
    assert windows.sessionize(ev, "device", "ts", 5).count() == 0
    main, late = routing.split_late(ev, "ts", "id")
    assert main.count() == 0 and late.count() == 0
    assert dedup.latest_improvements(ev, "device", "ts", "id").count() == 0


def test_null_keys_are_their_own_group(spark):
    rows = [(None, BASE), (None, BASE + dt.timedelta(seconds=3)), (1, BASE + dt.timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "user long, ts timestamp")
    got = sorted((r.user is None, r.num_interactions) for r in windows.sessionize(df, "user", "ts", 5).collect())
    assert got == [(False, 1), (True, 2)]
    got = sorted((r.user is None, r.num_interactions)
                 for r in windows.sessionize(df, "user", "ts", 5).collect())
    assert got == [(False, 1), (True, 2)]


def test_null_times_are_not_matched_and_not_lost_by_late_split(spark):
    rows = [(0, 1, BASE, 60.0), (1, 1, None, 60.0), (2, 1, BASE + dt.timedelta(seconds=5), 60.0)]
    df = spark.createDataFrame(rows, "id long, device long, ts timestamp, temp double")
    assert [r.id for r in patterns.hot_v1(df, "device", "ts", "temp", "id", 50.0, 2.0).collect()] == [2]
    main, late = routing.split_late(df, "ts", "id")
    assert main.count() + late.count() == 3


def test_keep_latest_ties_are_deterministic(spark):
    rows = [(1, BASE, 5), (1, BASE, 7), (1, BASE, 6)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, id long")
    assert dedup.keep_latest(df, "k", ["ts", "id"]).first().id == 7
    assert dedup.keep_first(df, "k", ["ts", "id"]).first().id == 5
