"""The content-addressed archive: odd pages, exact bytes, damaged stores, exported files."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from rostrum.llm import warc

BIG, OTHER = "ä" * 500, "b" * 1000  # 1000 bytes each
LONG = "<p>long ü</p>" * 300_000
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (2, "http://a/2", BIG), (None, "http://a/none", BIG), (3, None, "b" * 999), (4, "http://b/4", "b" * 999),
         (5, "http://b/5", None), (6, "http://b/6", ""), (None, None, OTHER), (None, "x", OTHER), (-9, "http://c/\r\nWARC-Type: resource\nX: y", LONG), (10, "u", LONG),
         (11, "u", "\r\n\r\nWARC/1.1\r\n\r\n\x00")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "d", "h", True) for p in PAGES], "page_id long, url string, html string, digest string, header string, inline boolean").repartition(4)


def read(archive, spark):
    of = lambda n: warc.field(F.col("header"), n)
    return archive.records(spark).select("page_id", of("WARC-Type").alias("kind"), warc.page_of(of("WARC-Refers-To")).alias("to"),
                                         warc.page_of(of("WARC-Record-ID")).alias("id"), "payload", "record", "inline").collect()


def test_pages(spark, pages):
    archive = warc.store(warc.of_pages(pages))
    rows = read(archive, spark)
    assert sorted((r.page_id is not None, r.page_id or 0, bytes(r.payload)) for r in rows) == sorted((p[0] is not None, p[0] or 0, (p[2] or "").encode()) for p in PAGES)
    kinds = {(r.id, r.kind, r.to) for r in rows}
    assert kinds == {(1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (3, "response", None), (4, "response", None), (5, "response", None),
                     (6, "response", None), (None, "response", None), (-9, "revisit", 10), (10, "response", None), (11, "response", None)}
    for r in rows:
        header, head, payload, inline = warc.split_record(bytes(r.record))  # checks the lengths
        assert inline == r.inline == (r.kind == "response") and payload == (bytes(r.payload) if inline else b"")
        assert header.count(b"WARC-Type:") == 2 if r.page_id == -9 else header.count(b"WARC-Type:") == 1
        assert f"sha1:{hashlib.sha1(bytes(r.payload)).hexdigest()}".encode() in header
    assert archive.payloads(spark).count() == len({(p[2] or "") for p in PAGES})
    assert warc.store(warc.of_pages(pages.limit(0))).records(spark).count() == 0


def test_files_keep_every_byte(spark, pages, tmp_path):
    archive = warc.store(warc.of_pages(pages))
    index = warc.export(archive, spark, f"file://{tmp_path}/warc")
    again = warc.store(warc.load(index))
    assert sorted(bytes(r.record) for r in again.records(spark).select("record").collect()) == sorted(bytes(r.record) for r in archive.records(spark).select("record").collect())
    foreign = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Type: text/plain\r\ncontent-length:  4 \r\n\r\n\xff\x00\r\n\r\n\r\n"
    h, head, payload, inline = warc.split_record(foreign)
    kept = warc.store(spark.createDataFrame([(bytearray(h), bytearray(head), bytearray(payload), inline)], "header binary, head binary, payload binary, inline boolean"))
    assert bytes(kept.records(spark).first().record) == foreign and (head, payload) == (b"", b"\xff\x00\r\n")
    with pytest.raises(ValueError):
        warc.split_record(foreign.replace(b" 4 ", b" 3 "))


def test_damage_is_found(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u", "x" * 2000), (2, "u", "y")], "page_id long, url string, html string")
    archive = warc.store(warc.of_pages(rows), f"{tmp_path}/a")
    bad = archive.payloads(spark).withColumn("payload", F.concat("payload", F.lit(b"!")))
    bad.write.parquet(f"{tmp_path}/b/payloads")
    archive.headers(spark).write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.Archive(f"{tmp_path}/b").records(spark).collect()
    archive.payloads(spark).filter("n_bytes = 1").write.parquet(f"{tmp_path}/c/payloads")
    os.rename(f"{tmp_path}/a/headers", f"{tmp_path}/c/headers")
    with pytest.raises(Exception, match="no payload"):
        warc.Archive(f"{tmp_path}/c").records(spark).collect()
