"""Content-addressed archive of WARC records.

A record is its exact header bytes, the head of its block (the HTTP header), and a payload. The archive keeps

* ``payloads(digest, n_bytes, payload)``: every payload once, under its sha256;
* ``headers(..., header, head, digest, inline)``: one row per record, with everything but the payload. A
  record whose block holds its payload is ``inline``; a revisit names its payload by digest only.

Joining both by digest gives back each record byte for byte, and the full payload of revisits as well.
Digests are verified: while writing, the payloads of one digest must agree in length and in a second digest;
while reading, the bytes must hash to the digest they are stored under, and every header must find its payload.

Equal payloads are combined inside each task before they are shuffled by digest, so a payload that a third
of all records share is moved once per task. Headers of such a payload meet it in a sort-merge join whose
large partitions adaptive execution splits.

Defined results for pages: a null or empty html is the empty payload; of the records with one payload of at
least ``least_bytes`` bytes that of the largest id is the response and the others revisit it; rows that
repeat that id with that payload are responses as well; rows without an id revisit like others, and are all
responses where no row of their payload has an id. Line breaks in a url are percent-encoded, so they
cannot add header fields. An empty table gives an empty archive. Further columns are ignored.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stage import new_path, stage

END = "\r\n"


@dataclass(frozen=True)
class Rules:
    #: Smaller payloads are never revisited.
    least_bytes: int = 1000
    date: str = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    folder: str

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/headers")

    def payloads(self, spark: SparkSession) -> DataFrame:
        """Every payload, its digest verified."""
        wrong = F.raise_error(F.concat(F.lit("payload differs from its digest "), F.hex("digest")))
        rows = spark.read.parquet(f"{self.folder}/payloads")
        checked = F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(wrong.cast("binary"))
        return rows.select("digest", "n_bytes", checked.alias("payload"))

    def records(self, spark: SparkSession) -> DataFrame:
        """The headers' columns, the full ``payload`` and the original ``record`` bytes."""
        headers = self.headers(spark)
        lost = F.raise_error(F.concat(F.lit("no payload of digest "), F.hex("digest")))
        joined = headers.join(self.payloads(spark).drop("n_bytes"), "digest", "left") \
            .withColumn("payload", F.coalesce("payload", lost.cast("binary")))
        body = F.when(F.col("inline"), F.col("payload")).otherwise(F.lit(b""))
        return joined.select(*headers.columns, "payload", F.concat("header", "head", body, F.lit((END + END).encode())).alias("record"))


def store(records: DataFrame, folder: str | None = None) -> Archive:
    """Write ``records(..., header, head, payload, inline)``; further columns stay with the headers."""
    spark = records.sparkSession
    folder = folder or new_path(spark, "archive")
    kept = [F.col(f"`{c}`") for c in records.columns if c not in ("payload", "digest")]
    payload = F.coalesce("payload", F.lit(b""))
    digest = F.unhex(F.sha2(payload, 256))
    records.select(*kept, digest.alias("digest")).write.parquet(f"{folder}/headers")
    copies = records.select(digest.alias("digest"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("n_bytes"), F.md5(payload).alias("check"))
    one = copies.groupBy("digest").agg(F.first("payload").alias("payload"), F.min(F.struct("n_bytes", "check")).alias("a"), F.max(F.struct("n_bytes", "check")).alias("b"))
    clash = F.raise_error(F.concat(F.lit("two payloads under the digest "), F.hex("digest")))
    one.select("digest", F.col("a.n_bytes").alias("n_bytes"), F.when(F.col("a") == F.col("b"), F.col("payload")).otherwise(clash.cast("binary")).alias("payload")) \
        .write.parquet(f"{folder}/payloads")
    return Archive(folder)


def _fields(*lines: Column) -> Column:
    """Header lines (those that are not null), closed by an empty one."""
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END)).cast("binary")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _one_line(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def of_pages(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules: Rules = Rules()) -> DataFrame:
    """A record per row: ``(page_id, header, head, payload, inline)``, for ``store``."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string").cast("binary"), F.lit(b""))
    pages = df.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), _one_line(F.col(f"`{url}`").cast("string")).alias("url"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    large = pages.filter(size >= rules.least_bytes).select("page_id", "url", F.sha2("payload", 256).alias("digest"))
    first = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = stage(first.select(F.col("digest").alias("of"), "first"), "archive-repeated")
    keyed = pages.withColumn("digest", F.when(size >= rules.least_bytes, F.sha2("payload", 256)))
    joined = keyed.join(first, F.col("digest") == F.col("of"), "left")
    revisit = F.col("first.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    head = _fields(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _line("Content-Length", size.cast("string")))
    only = lambda c: F.when(F.col("revisit"), c)
    header = _fields(
        F.lit("WARC/1.1"), _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))), F.lit(f"WARC-Date: {rules.date}"), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        only(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        only(_line("WARC-Refers-To", _urn(F.col("first.page_id")))), only(_line("WARC-Refers-To-Target-URI", F.col("first.url"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _line("Content-Length", (F.octet_length("head") + F.when(F.col("revisit"), 0).otherwise(size)).cast("string")))
    return joined.withColumn("revisit", F.coalesce(revisit, F.lit(False))).withColumn("head", head) \
        .select("page_id", header.alias("header"), "head", "payload", (~F.col("revisit")).alias("inline"))


def field(header: Column, name: str) -> Column:
    """The value of a named field of header bytes; null where there is none."""
    return F.nullif(F.regexp_extract(F.decode(header, "utf-8"), rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def page_of(urn: Column) -> Column:
    """The page id in a record id of ``of_pages``; null where it has none."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")


def export(archive: Archive, spark: SparkSession, folder: str) -> DataFrame:
    """Write the records as ``.warc.gz`` files, one gzip member each; returns ``(record_id, file, at, size)``.

    ``folder`` must be reachable from every executor. Each task writes a file of its own name, so a task that
    runs again leaves a file that the returned index does not name.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, at = None, "", 0
        for batch in batches:
            found = []
            for record_id, record in zip(batch.column(0).to_pylist(), batch.column(1)):
                if out is None:
                    file = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    fs, path = pfs.FileSystem.from_uri(file)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                member = gzip.compress(record.as_buffer(), 6, mtime=0)
                out.write(member)
                found.append((record_id, file, at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             ["record_id", "file", "at", "size"])
        if out is not None:
            out.close()

    rows = archive.records(spark).select(field(F.col("header"), "WARC-Record-ID").alias("record_id"), "record")
    return stage(rows.mapInArrow(write, "record_id string, file string, at long, size long"), "warc-index")


def split_record(record: bytes) -> tuple[bytes, bytes, bytes, bool]:
    """Header, head of the block, payload, and whether the block holds the payload."""
    end = record.index(b"\r\n\r\n") + 4
    header, block = record[:end], record[end:-4]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in header.split(b"\r\n"))}
    if int(fields[b"content-length"]) != len(block) or record[-4:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get(b'warc-record-id')!r} is not as long as its header says")
    cut = block.find(b"\r\n\r\n") + 4 if b"application/http" in fields.get(b"content-type", b"") else 0
    cut = len(block) if cut == 3 else cut
    return header, block[:cut], block[cut:], fields.get(b"warc-type") != b"revisit"


def load(index: DataFrame) -> DataFrame:
    """Records ``(header, head, payload, inline)`` of exported files, by their index; for ``store``.

    A revisit's payload is empty here: its file does not hold it.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                out = []
                for file, at, size in zip(*(batch.column(k).slice(i, 64).to_pylist() for k in range(3))):
                    if file != opened:
                        fs, path = pfs.FileSystem.from_uri(file)
                        opened, source = file, fs.open_input_file(path)
                    out.append(split_record(gzip.decompress(source.read_at(size, at))))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary() if k < 3 else pa.bool_()) for k in range(4)],
                                                 ["header", "head", "payload", "inline"])

    return index.select("file", "at", "size").mapInArrow(read, "header binary, head binary, payload binary, inline boolean")
