"""WARC archives: a writer of deduplicated records and a splittable reader.

*Writing.*  Every record is a gzip member of its own.  Spark's text writer
commits the files, so any file system and lost tasks are its business: a member
ends with the four bytes of its length, the last of which is zero below 16 MB
(longer records get an empty member, which ends in zeros, behind them), and that
zero byte is the writer's line separator.

*Reading.*  A file is read by tasks of ``split_bytes`` each.  A task looks for
the gzip magic in its byte range, takes a candidate for a member only if it
decodes and begins with a WARC version line, and owns the records that start
inside its range, reading beyond the end for the last one.  After a whole member
the next one is expected right behind it, past zero padding.  Where a record does
not start, the scan goes on byte by byte; damaged members are passed over.

Paths are opened by the tasks with pyarrow's file systems (local or mounted
paths, HDFS, object stores).  A stored copy of a WARC file inside a record would
be taken for records by a task whose range starts inside it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .frames import stored

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"  # of records without a crawl time
_READ = 1 << 18
_EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300") + bytes(8)

RECORD = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("refers_to_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """A header field has one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1F\x7F]", lambda m: f"%{ord(m[0]):02X}", text)


def member(record_id: str, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None, level: int = 4) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit of another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()
    return out if out[-1] == 0 else out + _EMPTY_MEMBER


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to): the pages whose payload a smaller page_id has.

    Only payloads of ``least_bytes`` or more are looked at.  Copies are counted
    on narrow rows, by digest, before anything is joined."""
    narrow = stored(pages.where(F.col("size") >= least_bytes).select("page_id", "digest"), "warc-digests")
    first = stored(narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-first")
    return stored(narrow.join(first, "digest").where("refers_to is not null and not page_id <=> refers_to").distinct(), "warc-revisits")


def _payloads(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"),
                        F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("size"))


def record_id(page_id: int | None) -> str:
    return "urn:page:" + ("none" if page_id is None else str(page_id))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> None:
    """Write a record per page under ``path``: equal payloads of ``least_bytes``
    or more once, at the smallest page_id, and revisit records for the others.

    A null html is an empty payload.  An empty table gives archives without
    records."""
    bodies = _payloads(pages, page_id, url, html)
    again = mark_revisits(bodies, least_bytes)
    rows = bodies.join(again, (bodies["page_id"].eqNullSafe(again["page_id"])) & (bodies["digest"] == again["digest"]), "left").select(
        bodies["page_id"], "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), bodies["digest"], "size", "refers_to")

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                    refers = None if r["refers_to"] is None else record_id(r["refers_to"])
                    out.append(member(record_id(r["page_id"]), r["url"], r["payload"] or b"", digest, r["size"], refers)[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    rows.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


class _Window:
    """Bytes of an open file around a moving position."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data, self.ended = file, start, bytearray(), False
        file.seek(start)

    def fill(self, upto: int) -> None:
        while not self.ended and self.base + len(self.data) < upto:
            more = self.file.read(_READ)
            self.ended = not more
            self.data += more

    def drop(self, before: int) -> None:
        if before - self.base >= _READ:
            del self.data[:before - self.base]
            self.base = before


def _decode(win: _Window, at: int) -> tuple[bytes, int] | None:
    """The content and end of the member at ``at``, or None if none with a WARC record is there."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    checked = False
    while not unpack.eof:
        win.fill(pos + _READ)
        piece = bytes(win.data[pos - win.base:pos - win.base + _READ])
        if not piece:
            return None
        try:
            got = unpack.decompress(piece)
        except zlib.error:
            return None
        pos += len(piece)
        out.append(got)
        if not checked and sum(map(len, out)) >= 5:
            checked = True
            if not b"".join(out).startswith(b"WARC/"):
                return None
    content = b"".join(out)
    return (content, pos - len(unpack.unused_data)) if content.startswith(b"WARC/") else None


def scan(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of every record that starts in [start, end)."""
    win, at = _Window(file, start), start
    while at < end:
        win.fill(at + _READ)
        i = win.data.find(MAGIC, at - win.base)
        if i < 0:  # the magic may stand across the end of what is held
            at = max(at, win.base + len(win.data) - 2)
            if win.ended:
                return
            win.drop(at)
            win.fill(at + _READ)
            continue
        at = win.base + i
        if at >= end:
            return
        found = _decode(win, at)
        if found is None:
            at += 1
            continue
        yield at, found[0]
        at = found[1]
        win.drop(at)


def parse(content: bytes) -> dict:
    """A record's fields; the payload is what follows the HTTP header of the block."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    block = block[:int(length)] if length.isdigit() else block
    kind, payload, size = fields.get("warc-type"), block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        size = int(told[1]) if told else None
    revisit = kind == "revisit"
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return {"record_type": kind, "record_id": fields.get("warc-record-id", "").strip("<>"), "url": fields.get("warc-target-uri"),
            "refers_to_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload_bytes": size if revisit else len(payload),
            "payload_digest": digest if revisit else sha1_base32(payload), "payload": None if revisit else payload}


def open_file(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    return system.open_input_file(path)


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """The records of all archives under ``path`` (columns ``RECORD``).

    response: size and digest are those of the payload that was read; revisit:
    as its header says.  An empty folder gives no rows; files without a record
    are passed over.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    ranges = files.where("length > 0").select("path", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"),
                                              "length")
    tasks = max(1, ranges.count())
    schema = T.StructType([f for f in RECORD.fields if payload or f.name != "payload"])
    names = schema.names

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                held, size = [], 0
                with open_file(r["path"]) as file:
                    for offset, content in scan(file, r["start"], min(r["length"], r["start"] + split_bytes)):
                        held.append({"path": r["path"], "offset": offset, **parse(content)})
                        size += len(content) + 200
                        if size > _READ * 4:
                            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], _ARROW[n]) for n in names], names=names)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], _ARROW[n]) for n in names], names=names)

    return ranges.repartition(min(tasks, 100_000), "path", "start").mapInArrow(run, schema)


_ARROW = {"path": pa.string(), "offset": pa.int64(), "record_type": pa.string(), "record_id": pa.string(),
          "refers_to_id": pa.string(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
          "payload": pa.binary()}


def digest(pages: DataFrame) -> DataFrame:
    """One row per page, read back from archives in the scratch folder: the columns of query ``op7_warc``."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    return read_archives(spark, path, payload=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to_id").alias("refers_to"))
