"""Content-addressed web archive.

An archive is two Parquet tables below one path: ``payloads`` keeps every distinct payload once under its SHA-256
digest, ``records`` keeps each record's exact header block with the digest of its payload.  Reading joins the two and
compares each stored payload with its digest, so a damaged payload ends the read instead of passing unnoticed.

``archive_pages`` writes a WARC/1.1 record per page: the first record of a payload of ``MIN_REVISIT`` bytes or more
is a response and later ones revisit it.  ``read_warc_files`` reads records from WARC files, plain or gzipped.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

#: Smaller payloads are written in full every time.
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
_BREAKS = r"[\x00-\x1F\x7F-\x9F\u2028\u2029]"


def _digest(payload: str) -> Column:
    return F.sha2(payload, 256)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; control characters and line separators of any kind in a value
    are percent-encoded."""
    each = F.transform(F.split(value, ""), lambda c: F.when(c.rlike(_BREAKS), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c))
    safe = F.when(value.rlike(_BREAKS), F.array_join(each, "")).otherwise(value)
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def _urn(page_id: str) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.col(page_id).cast("string"), F.lit(">"))


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  date: str = DATE) -> None:
    """Write one record per page below ``path``.

    The payload is the html in UTF-8, empty where it is null.  Of the records with equal payloads of at least
    ``MIN_REVISIT`` bytes, those with the smallest id are responses and the others revisit it; so rows that repeat an
    id are all responses, and where no record of a payload has an id all are responses.  A null url leaves its header
    line out, a null id both ids.  An empty table gives an empty archive; other columns are not read.
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("digest", _digest("payload")).withColumn("size", F.length("payload"))
    _store(base, path)
    small = base.drop("payload")  # payloads aren't moved for the headers
    shared = small.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = small.join(shared.select(F.col("digest").alias("of"), "first"), F.col("digest") == F.col("of"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    block = F.length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn("id")), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)), _line("WARC-Refers-To", F.when(revisit, _urn("first"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", block.cast("string")), F.lit(CRLF), http)
    _records(joined.select("id", F.encode(header, "UTF-8").alias("header"), "digest"), path)


def write_archive(records: DataFrame, path: str) -> None:
    """Write (id, header, payload) records below ``path``; header and payload are binary and the header is all that
    stands before the payload.  A null payload counts as empty."""
    digested = records.withColumn("payload", F.coalesce("payload", F.lit(b""))).withColumn("digest", _digest("payload"))
    _store(digested, path)
    _records(digested, path)


def _store(digested: DataFrame, path: str) -> None:
    digested.groupBy("digest").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")


def _records(digested: DataFrame, path: str) -> None:
    digested.select("id", "header", "digest").write.option("compression", "zstd").parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(id, header, payload, digest, payload_bytes) of every record; fails on a payload that isn't its digest's."""
    stored = spark.read.parquet(f"{path}/payloads")
    checked = F.when(_digest("payload") == F.col("digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
    stored = stored.select(F.col("digest").alias("stored"), "payload", F.length("payload").cast("long").alias("payload_bytes"), checked.alias("checked"))
    records = spark.read.parquet(f"{path}/records")
    return records.join(stored, records.digest == F.col("stored")).select("id", "header", "payload", F.col("checked").alias("digest"), "payload_bytes")


def field(name: str) -> Column:
    """The value of a WARC header line of column ``header``, or null.  Lines end at CR LF only, and the WARC header at
    the first empty line: what stands in a value or in the HTTP header isn't read."""
    value = F.regexp_extract(F.substring_index(F.decode("header", "UTF-8"), CRLF * 2, 1), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def record_bytes(archive: DataFrame) -> DataFrame:
    """(id, record): the records as they stand in a WARC file; a revisit has no payload."""
    body = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.select("id", F.concat("header", body, F.lit((CRLF * 2).encode())).alias("record"))


def _parse(content: bytes, path: str = "") -> Iterator[tuple[bytes, bytes]]:
    """(header, payload) of every record of a WARC file; HTTP headers belong to the header.  A record that is cut off or
    doesn't tell its length is an error that names file and place."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while (at := content.find(b"WARC/", at)) >= 0:
        end = content.find(b"\r\n\r\n", at) + 4
        if end < 4:
            raise ValueError(f"{path}: the record at byte {at} is cut off in its header")
        fields = dict(line.split(b":", 1) for line in content[at:end].split(b"\r\n")[1:] if b":" in line)
        fields = {k.strip().lower(): v.strip() for k, v in fields.items()}
        if not fields.get(b"content-length", b"").isdigit():
            raise ValueError(f"{path}: the record at byte {at} has no Content-Length")
        stop = end + int(fields[b"content-length"])
        if stop > len(content):
            raise ValueError(f"{path}: the record at byte {at} is cut off, {stop - len(content)} bytes are missing")
        split = content.find(b"\r\n\r\n", end, stop) + 4 if fields.get(b"content-type", b"").startswith(b"application/http") else end
        split = split if split > 3 else end
        yield content[at:split], content[split:stop]
        at = stop


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            header, payload = [], []
            for one, two in _parse(content, path):
                header.append(one)
                payload.append(two)
            yield pa.record_batch([pa.array([path] * len(header), pa.string()), pa.array(range(len(header)), pa.int64()),
                                   pa.array(header, pa.binary()), pa.array(payload, pa.binary())], ["file", "place", "header", "payload"])


def read_warc_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, place, header, payload) of the records in WARC files; a file is read by one task."""
    ship(spark)
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(_parse_files, "file string, place long, header binary, payload binary")
