"""Two-level running aggregates equal a plain window."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riverbend.operators import prefix
from riverbend.operators.prefix import bucketed_prefix, sorted_buckets


def _data(spark, seed=7, n=400):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 2, 3]), i, rnd.randint(-50, 50) if rnd.random() > 0.05 else None)
            for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k long, o long, v long")


def _expected(df, kind, inclusive):
    end = 0 if inclusive else -1
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, end)
    f = {"max": F.max, "min": F.min, "sum": F.sum}[kind]
    return {(r.k, r.o): r.e for r in df.select("k", "o", f("v").over(w).alias("e")).collect()}


@pytest.mark.parametrize("bits", [0, 2, 5, 20])
def test_matches_window(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix, "BUCKET_BITS", bits)
    df = _data(spark)
    for kind in ("max", "min", "sum"):
        for inclusive in (False, True):
            got = bucketed_prefix(df, ["k"], [F.col("o")], F.col("v"), kind=kind, inclusive=inclusive, out="p")
            assert {(r.k, r.o): r.p for r in got.collect()} == _expected(df, kind, inclusive), (kind, inclusive)


def test_hot_key_and_ties_are_cut_into_bounded_buckets(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_BITS", 6)
    rows = [(1, 7, i) for i in range(3000)] + [(2, i, i) for i in range(10)]  # all of key 1 tie in the first column
    df = spark.createDataFrame(rows, "k long, o long, i long")
    cut = sorted_buckets(df, ["k"], [F.col("o"), F.col("i")], "b")
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert max(sizes) <= 64 and len(sizes) >= 3010 / 64
    spans = cut.filter("k = 1").groupBy("b").agg(F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy("b").collect()
    assert all(x.hi < y.lo for x, y in zip(spans, spans[1:]))  # buckets never decrease along the order
    got = bucketed_prefix(df, ["k"], [F.col("o"), F.col("i")], F.lit(1), kind="sum", inclusive=True, out="p")
    assert {(r.k, r.i): r.p for r in got.collect()} == {(k, i): i + 1 for k, _, i in rows}


def test_one_key_runs_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_BITS", 4)
    df = spark.createDataFrame([(1, i) for i in range(2000)], "k long, o long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = bucketed_prefix(df, ["k"], [F.col("o")], F.col("o"), out="p")
        assert out.select(F.spark_partition_id().alias("t")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_null_order_rows_are_kept(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 1, 3), (1, 2, 9), (2, None, 1)], "k long, o long, v long")
    got = bucketed_prefix(df, ["k"], [F.col("o")], F.col("v"), kind="max", out="p")
    assert sorted(((r.k, r.o, r.p) for r in got.collect()), key=str) == sorted(
        [(1, None, None), (1, 1, 5), (1, 2, 5), (2, None, None)], key=str)


def test_rows_are_shuffled_once_after_the_sort(spark):
    """The rows are exchanged once, besides the bucket totals and their carries."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = bucketed_prefix(_data(spark), ["k"], [F.col("o")], F.col("v"), out="p")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    assert len(re.findall(r"\bWindow \[", plan)) == 2 and "SinglePartition" not in plan
    assert sum("__rb_bucket" in s for s in shuffles) == 3  # totals, carries and rows, each once
    assert len(shuffles) <= 4
