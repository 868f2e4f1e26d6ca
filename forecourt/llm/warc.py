"""WARC archives: a writer by Spark's own file commit and a splittable reader.

Writing: every record is a gzip member.  Of records with equal payloads the one
with the smallest id is a response, the others are revisits that refer to it.
Spark's text writer stores the members, so tasks that are tried again leave no
second copy and any file system that Spark can write to will do.  That writer
ends each row with a separator; a gzip member ends with the size of its content,
whose highest byte is zero below 16 MiB, so the separator is that byte and the
row is the member without it (a larger member is followed by an empty one).

Reading: files are cut into byte ranges, one task for each.  A task looks for
the gzip magic in its range, takes a candidate for a member only if it inflates
to a record header, and owns the records that start inside, reading past its
end for the last one.  After a member the next one is tried right behind it.
Ranges need only the files' names and sizes.

* null payload: empty; null url: no target header; null id: an empty id.
* equal ids and payloads (repeated rows): all of them are responses.
* a damaged member is passed over; the scan goes on behind its magic.
* a file system that only Spark can open is read through ``binaryFile``, one
  task a file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import map_blocks, prepare

MAGIC = b"\x1f\x8b\x08"
SPLIT = 32 << 20
STEP = 1 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("path string, offset long, type string, record_id string, refers_to string, target_uri string, "
          "header_digest string, payload_digest string, payload_bytes long, payload binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --------------------------------------------------------------- writing
def record(kind: str, record_id: str, url: str | None, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit has the headers of the payload but not itself."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that ends with a zero byte."""
    def pack(x: bytes) -> bytes:
        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        return z.compress(x) + z.flush()

    out = pack(data)
    return out if out.endswith(b"\0") else out + pack(b"")


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0) -> None:
    """A record for every row, under ``path``.  Payloads under ``least_bytes``
    are always responses."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.sha1(F.col("text").cast("binary")))
    first = rows.select("key", "id").groupBy("key").agg(F.min("id").alias("first"))
    rows = rows.join(first, "key").withColumn(
        "again", ~F.col("id").eqNullSafe(F.col("first")) & (F.octet_length("text") >= least_bytes))

    def pack(block: pa.RecordBatch) -> dict:
        out = []
        for r in block.to_pylist():
            payload = r["text"].encode()
            urn = [f"urn:page:{'' if x is None else x}" for x in (r["id"], r["first"])]
            out.append(member(record("revisit" if r["again"] else "response", urn[0], r["url"], payload,
                                     digest(payload), urn[1]))[:-1])
        return {"data": out}

    packed = map_blocks(rows.select("id", "first", "url", "text", "again"), "text", "data binary", pack)
    # a binary cast to a string keeps its bytes
    packed.select(F.col("data").cast("string")).write.mode("overwrite").option("lineSep", "\0").text(path)


# --------------------------------------------------------------- reading
def members(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the WARC members of a file that start in [start, end)."""
    at = start
    while at < end:
        f.seek(at)
        chunk = f.read(len(MAGIC))
        if chunk != MAGIC:  # right behind a member there is the next one
            chunk += f.read(STEP)
        if len(chunk) < len(MAGIC):
            return
        hit = chunk.find(MAGIC)
        if hit < 0:
            at += len(chunk) - len(MAGIC) + 1
            continue
        if at + hit >= end:
            return
        at += hit
        content, after = inflate(f, at)
        if content is not None:
            yield at, content
        at = after if after is not None else at + 1


def inflate(f, at: int) -> tuple[bytes | None, int | None]:
    """The content of the member at ``at`` if it is a WARC record, and where it
    ends (None: no member begins here).  Its header is decoded before the rest."""
    z, parts, head, pos = zlib.decompressobj(31), [], b"", at
    step = 1 << 14
    f.seek(at)
    try:
        while not z.eof:
            chunk = f.read(step)
            if not chunk:
                return None, None
            pos += len(chunk)
            parts.append(z.decompress(chunk))
            if len(head) < 5:
                head += parts[-1][:5]
                if not head.startswith(b"WARC/"[:len(head)]):
                    return None, None
            step = STEP
    except zlib.error:
        return None, None
    content = b"".join(parts)
    return (content if content.startswith(b"WARC/") else None), pos - len(z.unused_data)


def parse(content: bytes) -> dict:
    """The fields of a record; a revisit's payload size is that of its HTTP header."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[:int(fields.get("content-length") or 0)]
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if fields.get("warc-type") == "revisit":
            declared = re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)
            size = int(declared[1]) if declared else None
    revisit = fields.get("warc-type") == "revisit"
    bare = lambda x: None if x is None else x.removeprefix("<").removesuffix(">")
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    uri = fields.get("warc-target-uri")
    return {"type": fields.get("warc-type"), "record_id": bare(fields.get("warc-record-id")),
            "refers_to": bare(fields.get("warc-refers-to")),
            "target_uri": None if uri is None else re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), uri),
            "header_digest": said, "payload_digest": said if revisit else digest(payload),
            "payload_bytes": size, "payload": None if revisit else payload}


def open_file(path: str):
    """A file of any store that Arrow knows."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_file(name)


def read_archives(spark: SparkSession, path: str, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """One row per record of all ``.gz`` members under ``path``; without
    ``payloads`` that column is null (digests are still taken from the payload)."""
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    prepare(spark)
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), *(
        (n, pa.string()) for n in ("type", "record_id", "refers_to", "target_uri", "header_digest", "payload_digest")),
        ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def rows(path: str, f, start: int, end: int) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for offset, content in members(f, start, end):
            r = parse(content) | {"path": path, "offset": offset}
            if not payloads:
                r["payload"] = None
            out.append(r)
            size += 500 + len(r["payload"] or b"")
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with open_file(r["path"]) as f:
                    yield from rows(r["path"], f, r["start"], r["end"])

    def by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield from rows(r["path"], io.BytesIO(r["content"]), 0, len(r["content"]))

    sizes = source.select("path", "length")
    n, sample = sizes.agg(F.sum(F.ceil(F.col("length") / split)), F.min("path")).first()
    try:
        if sample is not None:
            open_file(sample).close()
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return source.select("path", "content").mapInArrow(by_file, RECORD)
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split).cast("long")))
    ranges = sizes.select("path", "length", begin.alias("start")).select(
        "path", "start", F.least(F.col("start") + split, "length").alias("end"))
    return ranges.repartition(max(1, int(n or 1))).mapInArrow(by_range, RECORD)
