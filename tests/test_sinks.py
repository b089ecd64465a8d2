"""Partitioned Parquet (batch and stream), compaction, exactly-once, fan-out."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import Row
from pyspark.sql import types as T

from riverbend.functions.time import day_partition, ts_text_nanos
from riverbend.streaming import sinks
from riverbend.streaming.state import run_available

TXN = T.StructType([T.StructField("t_time", T.StringType()), T.StructField("t_id", T.LongType()),
                    T.StructField("t_customer_id", T.LongType()), T.StructField("t_amount", T.DecimalType(10, 2)),
                    T.StructField("t_date", T.StringType())])
# three days, one with a row that came twice
PAID = [("2023-02-11 06:15:09", 20, 3, "410.05"), ("2023-02-12 09:00:00", 21, 4, "8.50"), ("2023-02-12 09:00:00", 21, 4, "8.50"),
        ("2023-02-20 21:45:30", 22, 3, "63.00"), ("2023-02-20 21:50:00", 23, 6, "17.25"), ("2023-02-20 23:59:59", 24, 6, "2.40")]


def _g3(spark):
    df = spark.createDataFrame(PAID, "t string, t_id long, t_customer_id long, a string")
    ts = F.to_timestamp("t")
    return df.select(ts_text_nanos(ts).alias("t_time"), day_partition(ts).alias("t_date"), "t_id",
                     "t_customer_id", F.col("a").cast("decimal(10,2)").alias("t_amount"))


def test_parquet_roundtrip_golden(spark):
    # six rows back, duplicate kept, nanosecond text, day partition value
    path = sinks.write_partitioned(_g3(spark), "t_date", sinks.new_output(spark, "g3"), split_by="t_id")
    back = spark.read.schema(TXN).parquet(path).orderBy("t_id").collect()
    assert len(back) == 6
    assert back[0].t_time == "2023-02-11 06:15:09.000000000" and back[0].t_date == "2023_02_11"
    assert back[0].t_amount == Decimal("410.05")
    assert spark.read.parquet(path).filter("t_date = '2023_02_20'").count() == 3  # partition pruning


def test_compaction_keeps_rows(spark):
    path = sinks.new_output(spark, "many")
    _g3(spark).repartition(6).write.partitionBy("t_date").parquet(path)  # many small files
    sinks.write_partitioned(_g3(spark).limit(1).withColumn("t_date", F.lit("2023_03_01")), "t_date", path, mode="append")
    rows = lambda: sorted(map(tuple, spark.read.schema(TXN).parquet(path).collect()))
    files = lambda: {r.f for r in spark.read.schema(TXN).parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    before, n_before = rows(), files()
    assert sinks.compact(spark, path, "t_date", TXN, split_by="t_id") == len(n_before) - 2  # two folders of one file
    assert rows() == before
    counts = {r.t_date: r.n_files for r in sinks.files_per_folder(spark.read.schema(TXN).parquet(path), "t_date").collect()}
    assert len(files()) < len(n_before) and set(counts) == {"2023_02_11", "2023_02_12", "2023_02_20", "2023_03_01"}
    single = [f for f in n_before if "2023_02_11" in f or "2023_03_01" in f]
    assert set(single) <= files()  # folders of one file are left alone


def test_hot_day_is_written_by_many_tasks(spark):
    df = spark.range(4000).select(F.lit("2024_01_01").alias("d"), F.col("id"))
    path = sinks.write_partitioned(df, "d", sinks.new_output(spark, "hot-day"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.StringType())])
    assert sinks.files_per_folder(spark.read.schema(schema).parquet(path), "d").first().n_files > 1


def test_print_sink_prints_every_row(spark, capsys):
    # the executors' output isn't captured here: run the query, and the writer by itself
    src = sinks.new_output(spark, "print-src")
    spark.range(100).coalesce(3).write.parquet(src)
    q = sinks.print_sink(spark.readStream.schema("id long").parquet(src), sinks.new_output(spark, "print-ck"), "p")
    run_available(q)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 100
    for k in range(100):
        sinks.LinePrinter("p", False).process(Row(line=f'{{"id":{k}}}'))
    assert capsys.readouterr().out.splitlines() == [f'p> {{"id":{k}}}' for k in range(100)]


def test_stream_partitioned_parquet(spark):
    src = sinks.new_output(spark, "g3-src")
    _g3(spark).write.parquet(src)
    schema = spark.read.parquet(src).schema
    out = sinks.new_output(spark, "g3-stream")
    run_available(sinks.stream_partitioned(spark.readStream.schema(schema).parquet(src), "t_date", out,
                                           sinks.new_output(spark, "g3-ck")))
    assert spark.read.schema(TXN).parquet(out).count() == 6


def test_exactly_once_across_restart(spark):
    # G15: 50 strings in, 50 out, with a restart in the middle
    src, out, ck = (sinks.new_output(spark, n) for n in ("eo-src", "eo-out", "eo-ck"))
    spark.createDataFrame([(f"s{i}",) for i in range(25)], "v string").coalesce(1).write.parquet(src)
    schema = T.StructType([T.StructField("v", T.StringType())])
    run_available(sinks.exactly_once_copy(spark.readStream.schema(schema).parquet(src), out, ck))
    spark.createDataFrame([(f"s{i}",) for i in range(25, 50)], "v string").coalesce(1).write.mode("append").parquet(src)
    run_available(sinks.exactly_once_copy(spark.readStream.schema(schema).parquet(src), out, ck))
    # a third start with no new input adds nothing
    run_available(sinks.exactly_once_copy(spark.readStream.schema(schema).parquet(src), out, ck))
    vals = [r.v for r in spark.read.parquet(out).collect()]
    assert len(vals) == 50 and len(set(vals)) == 50


def test_fan_out_reads_source_once_and_writes_all(spark):
    src = sinks.new_output(spark, "fan-src")
    spark.createDataFrame([(i, "CRITICAL" if i % 3 == 0 else "MINOR") for i in range(30)],
                          "id long, priority string").write.parquet(src)
    schema = spark.read.parquet(src).schema
    a, b = sinks.new_output(spark, "fan-a"), sinks.new_output(spark, "fan-b")
    q = sinks.fan_out(spark.readStream.schema(schema).parquet(src), {
        "critical": (lambda d: d.filter("priority = 'CRITICAL'"), sinks.parquet_batch_writer(a)),
        "all": (lambda d: d, sinks.parquet_batch_writer(b)),
    }, sinks.new_output(spark, "fan-ck"))
    run_available(q)
    assert spark.read.parquet(a).count() == 10
    assert spark.read.parquet(b).count() == 30


def test_csv_folder_files_arrive_between_batches(spark):
    # G13: 10 rows per file, ids ascending, files land complete in the watched folder
    from riverbend.sources import files

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("character", T.StringType()),
                           T.StructField("location", T.StringType())])
    src, out, ck = (sinks.new_output(spark, n) for n in ("g13-src", "g13-out", "g13-ck"))
    for f in range(3):
        rows = [(f * 10 + i, f"char{f * 10 + i}", f"loc{i}") for i in range(10)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").csv(src)
        run_available(sinks.exactly_once_copy(files.csv_stream(spark, src, schema), out, ck))
    back = spark.read.schema(schema).parquet(out).orderBy("id").collect()
    assert [r.id for r in back] == list(range(30))
    assert back[13].character == "char13" and back[13].location == "loc3"
