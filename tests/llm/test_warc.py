"""Archive round trips: records byte for byte, payloads once, damage found."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from riverbend.llm import warc
from riverbend.session import scratch_dir

PAGES = "page_id long, url string, html string, header string, digest int"


def _archive(spark, rows):
    path = scratch_dir(spark, "warc-test")
    warc.archive_pages(spark.createDataFrame([(*r, "own", 1) for r in rows], PAGES), path)
    return path


def test_records_and_payloads(spark):
    big, other = "é" * 60 + "<p>", "x" * 100
    rows = [(5, "http://a", big), (3, "http://b\r\nX: y", big), (9, None, other), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""),
            (None, "u", big), (7, "u", "y" * 99), (8, "u", "y" * 99), (None, "n", "z" * 200), (None, "n", "z" * 200), (3, "again", big)]
    path = _archive(spark, rows)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in rows})
    out = warc.read_archive(spark, path).select(
        "id", "payload", "digest", "payload_bytes", warc.field("WARC-Type").alias("kind"), warc.field("WARC-Refers-To").alias("refers"),
        warc.field("WARC-Target-URI").alias("url")).collect()
    assert len(out) == len(rows)
    kinds = {}
    for r in out:
        assert r.digest == hashlib.sha256(r.payload).hexdigest() and r.payload_bytes == len(r.payload)
        kinds.setdefault((r.id, bytes(r.payload).decode()), set()).add((r.kind, r.refers))
    assert kinds[5, big] == {("revisit", "<urn:x-page:3>")} and kinds[3, big] == {("response", None)}
    assert kinds[None, big] == {("revisit", "<urn:x-page:3>")}
    assert all(kinds[k, t] == {("response", None)} for k, t in ((1, "small"), (2, "small"), (4, ""), (6, ""), (7, "y" * 99), (8, "y" * 99), (None, "z" * 200)))
    assert {r.url for r in out if r.id == 3} == {"http://b%0D%0AX: y", "again"} and [r.url for r in out if r.id == 9] == [None]


def test_exact_records_through_warc_files(spark, tmp_path):
    rows = [(k, f"http://h/{k}", f"<p>{k % 3}</p>\r\n\r\nWARC/1.1\r\n" * 20) for k in range(9)] + [(20, "e", "")]
    records = {r.id: bytes(r.record) for r in warc.record_bytes(warc.read_archive(spark, _archive(spark, rows))).collect()}
    assert len(records) == 10 and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records.values())
    (tmp_path / "plain.warc").write_bytes(b"".join(records[k] for k in range(5)))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(gzip.compress(records[k]) for k in (5, 6, 7, 8, 20)))
    read = warc.read_warc_files(spark, str(tmp_path))
    assert read.count() == 10
    # archived again and read back, each record is the one that stood in the file
    path = scratch_dir(spark, "warc-again")
    warc.write_archive(read.select(F.concat_ws("#", F.element_at(F.split("file", "/"), -1), "place").alias("id"), "header", "payload"), path)
    again = {bytes(r.record) for r in warc.record_bytes(warc.read_archive(spark, path)).collect()}
    assert again == set(records.values())


@pytest.mark.parametrize("mark", ["\u0085", "\u2028", "\u2029", "\r", "\n", "\r\n", "\x0b", "\x0c", "\r\n\r\n"])
def test_no_url_forges_a_header(spark, mark):
    big = "b" * 200
    urls = [f"http://a/{mark}WARC-Refers-To: <urn:x-page:7>", f"{mark}WARC-Type: revisit{mark}", "http://a/é%20 plain"]
    rows = warc.read_archive(spark, _archive(spark, [(k, u, big if k else "own") for k, u in enumerate(urls)])).select(
        "id", warc.field("WARC-Type").alias("kind"), warc.field("WARC-Refers-To").alias("refers"), warc.field("WARC-Target-URI").alias("url"), "header").collect()
    code = "".join(f"%{b:02X}" for b in mark.encode())
    assert sorted((r.id, r.kind, r.refers) for r in rows) == [(0, "response", None), (1, "response", None), (2, "revisit", "<urn:x-page:1>")]
    assert {r.url for r in rows} == {u.replace(mark, code) for u in urls}
    assert all(len(bytes(r.header).split(b"\r\n\r\n")) == 3 for r in rows)


def test_http_headers_are_no_warc_headers(spark):
    path = scratch_dir(spark, "warc-http")
    header = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 60\r\n\r\nHTTP/1.1 200 OK\r\nWARC-Refers-To: x\r\nWARC-Type: revisit\r\n\r\n"
    warc.write_archive(spark.createDataFrame([(1, bytearray(header), bytearray(b"p"))], "id long, header binary, payload binary"), path)
    assert tuple(warc.read_archive(spark, path).select(warc.field("WARC-Type"), warc.field("WARC-Refers-To")).first()) == ("response", None)


def test_records_that_are_cut_off():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [p for _, p in warc._parse(good * 2)] == [b"abc", b"abc"]
    for bad, said in ((good + b"WARC/1.1\r\nContent-", "cut off in its header"), (good + good[:-6], "2 bytes are missing"),
                      (b"WARC/1.1\r\nX: y\r\n\r\n", "no Content-Length")):
        with pytest.raises(ValueError, match=f"f.warc: .*{said}"):
            list(warc._parse(bad, "f.warc"))


def test_damaged_payload_is_found(spark):
    path = _archive(spark, [(1, "u", "a" * 200), (2, "u", "b" * 200)])
    stored = spark.createDataFrame(spark.read.parquet(f"{path}/payloads").collect())
    stored.withColumn("payload", F.when(F.length("payload") > 0, F.lit(b"other")).otherwise(F.col("payload"))).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, path).collect()


def test_empty_table_and_very_long_page(spark):
    assert warc.read_archive(spark, _archive(spark, [])).count() == 0
    out = warc.read_archive(spark, _archive(spark, [(1, "u", "é" * 2_000_000)])).first()
    assert out.payload_bytes == 4_000_000
