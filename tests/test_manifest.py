"""A streamed table that is compacted as it is written."""

from pyspark.sql import functions as F

from riverbend.streaming import sinks
from riverbend.streaming.manifest import ManifestTable, stream_to_manifest
from riverbend.streaming.state import run_available

SCHEMA = "id long, text string, day string"


def _df(spark, ids, days=3):
    return spark.createDataFrame([(k, f"text {k}", f"2024_01_{k % days:02d}") for k in ids], SCHEMA)


def _table(spark, small=1 << 20):
    return ManifestTable(spark, sinks.new_output(spark, "manifest"), spark.createDataFrame([], SCHEMA).schema, "day", small)


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_one_small_file_a_day_and_old_versions(spark):
    t = _table(spark)
    assert t.versions() == [] and t.read().count() == 0
    for b in range(4):
        t.append(_df(spark, range(b * 30, b * 30 + 30)).repartition(4), b)
        counts = {r.folder: r.n for r in t.files().groupBy("folder").agg(F.count("*").alias("n")).collect()}
        assert counts == {f"2024_01_{d:02d}": 1 for d in range(3)}
    assert _ids(t.read()) == list(range(120)) and _ids(t.read(1)) == list(range(60)) and t.versions() == [0, 1, 2, 3]
    assert {(r.id, r.text, r.day) for r in t.read().collect()} == {(r.id, r.text, r.day) for r in _df(spark, range(120)).collect()}


def test_only_touched_days_and_small_files_are_rewritten(spark):
    t = _table(spark)
    t.append(_df(spark, range(30)), 0)
    before = {r.folder: r.file for r in t.files().collect()}
    t.append(_df(spark, range(30, 60)).filter("day = '2024_01_01'"), 1)
    after = {r.folder: r.file for r in t.files().collect()}
    assert before["2024_01_00"] == after["2024_01_00"] and before["2024_01_01"] != after["2024_01_01"]
    big = _table(spark, small=1)  # no file is small: none is taken up
    for b in range(2):
        big.append(_df(spark, range(b * 30, b * 30 + 30)), b)
    assert big.files().count() == 6 and _ids(big.read()) == list(range(60))
    many = ManifestTable(spark, sinks.new_output(spark, "manifest"), t.schema, "day", 1 << 20, file_rows=5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    many.append(_df(spark, range(60)).filter("day = '2024_01_01'"), 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert 2 <= many.files().count() <= 4 and many.read().count() == 20  # a large day is written by several tasks


def test_replays_and_failures_change_nothing(spark):
    t = _table(spark)
    t.append(_df(spark, range(30)), 0)
    t.append(_df(spark, range(30, 60)), 1)
    listed = sorted(r.file for r in t.files().collect())
    t.append(_df(spark, range(500, 600)), 1)  # committed already
    assert sorted(r.file for r in t.files().collect()) == listed
    # a batch that died after its data and before its manifest was whole
    _df(spark, range(60, 70)).write.partitionBy("day").parquet(t._data(2))
    spark.createDataFrame([("x", "gone", 1)], "folder string, file string, bytes long").write.parquet(t._manifest(2))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{t._manifest(2)}/_SUCCESS")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, False)
    assert t.versions() == [0, 1] and _ids(t.read()) == list(range(60))
    t.append(_df(spark, range(60, 90)), 2)
    assert _ids(t.read()) == list(range(90)) and _ids(t.read(0)) == list(range(30))


def test_vacuum_keeps_the_last_versions(spark):
    t = _table(spark)
    for b in range(4):
        t.append(_df(spark, range(b * 30, b * 30 + 30)), b)
    assert t.vacuum(2) == 6
    assert t.versions() == [2, 3] and _ids(t.read()) == list(range(120)) and _ids(t.read(2)) == list(range(90))
    assert t.vacuum(2) == 0


def test_stream_writes_it(spark):
    t, src, ck = _table(spark), sinks.new_output(spark, "m-src"), sinks.new_output(spark, "m-ck")
    for b in range(3):
        _df(spark, range(b * 20, b * 20 + 20)).repartition(3).write.mode("append").parquet(src)
        run_available(stream_to_manifest(spark.readStream.schema(SCHEMA).parquet(src), t, ck))
    run_available(stream_to_manifest(spark.readStream.schema(SCHEMA).parquet(src), t, ck))
    assert _ids(t.read()) == list(range(60)) and t.files().count() == 3
