"""WARC records from legacy ARC archives.

An ARC file begins with a version block, ``filedesc://name ip date text/plain [...] length``, whose body names the version and
the fields of the record lines: five in version 1 (URL, IP address, date, content type, length), ten in version 2 (result code,
checksum, location, offset and file name before the length). ``read_arc`` takes the version from that block, splits every record
line by its version's fields and takes as many bytes as it declares. ``to_warc`` synthesises the WARC equivalent of a record:
an identifier that is a UUID of its content (so a second conversion names it alike), the ARC date as a W3C timestamp, the record
type, and SHA-1 digests of block and payload. Of records with equal payloads one is the response, the others revisit it and
carry only their HTTP headers.

Archives are tables of segments (archive, segment, data): bytes of whole gzip members, one per record, which in segment order
are a .warc.gz file. Segments are rows, as executors share no folder but what Spark itself writes to; ``read_archives`` reads any
subset of them on its own.

Defined results: a null html is an empty payload, which is compared like any other; a null url is written as ``unknown:``; white space in
URLs is percent-encoded in the record lines; pages that share payload and page_id are written alike, so when it is the largest page_id
all of them are responses; a null page_id is smaller than any other; an empty table gives an empty result; other columns are ignored.

Scale: digests are taken first, and only (digest, page_id) are grouped, with map-side maxima, so a payload that a third of all pages share
costs a row per task; the payloads are shuffled once at most. A segment is a bounded number of records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.common import Stages

SEGMENT_BYTES = 4 << 20
CRLF = b"\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: names that are URLs
FIELDS = {1: ("url", "ip", "date", "mime", "length"),
          2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length")}


@dataclass
class ArcRecord:
    fields: dict[str, str]
    block: bytes


def write_arc(name: str, records: list[tuple[dict[str, str], bytes]], version: int) -> bytes:
    """An ARC file of (fields, block); the lengths are filled in."""
    names = " ".join({"url": "URL", "ip": "IP-address", "date": "Archive-date", "mime": "Content-type", "length": "Archive-length", "status": "Result-code",
                      "checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename"}[f] for f in FIELDS[version])
    about = f"{version} 0 -\n{names}\n".encode()
    out = bytearray()
    head = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": "19960101000000", "mime": "text/plain", "status": "200", "checksum": "-",
            "location": "-", "offset": "0", "filename": name}
    for fields, block in [(head, about), *records]:
        own = {"status": "200", "checksum": "-", "location": "-", "filename": name, "offset": str(len(out)), **fields, "length": str(len(block))}
        out += " ".join(own[f] for f in FIELDS[version]).encode() + b"\n" + block + b"\n"
    return bytes(out)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file after its version block."""
    at, fields = 0, None
    while at < len(data):
        if data[at:at + 1] == b"\n":  # between records
            at += 1
            continue
        eol = data.index(b"\n", at)
        line = data[at:eol].decode("utf-8", "replace").rstrip("\r").split(" ")
        block = data[eol + 1:eol + 1 + int(line[-1])]
        if len(block) < int(line[-1]):
            raise ValueError(f"record at {at}: {line[-1]} bytes are declared, {len(block)} follow")
        at = eol + 1 + len(block)
        if fields is None:
            if not line[0].startswith("filedesc://"):
                raise ValueError("an ARC file begins with a filedesc: record")
            fields = FIELDS[int(block.split(b" ", 1)[0])]
            continue
        if len(line) != len(fields):
            raise ValueError(f"record line of {len(line)} fields, version has {len(fields)}")
        yield ArcRecord(dict(zip(fields, line, strict=True)), block)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(url: str, date: str, page: str, digest: str) -> str:
    return uuid.uuid5(NAMESPACE, f"{url}\n{date}\n{page}\n{digest}").urn


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head, with its empty line, and payload of an HTTP response."""
    at = block.find(CRLF + CRLF)
    return (block, b"") if at < 0 else (block[:at + 4], block[at + 4:])


def w3c_date(arc_date: str) -> str:
    d = (arc_date + "00000101000000"[len(arc_date):])[:14] if re.fullmatch(r"\d{4,14}", arc_date) else "19960101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)\r?$", head)
    return m and m[1].decode()


def to_warc(record: ArcRecord, refers_to: str | None = None) -> bytes:
    """The WARC record; a revisit of the record ``refers_to``, if given."""
    f = record.fields
    head, payload = split_http(record.block)
    digest, page = sha1_base32(payload), http_header(head, "X-Page-Id") or ""
    block = record.block if refers_to is None else head
    lines = [b"WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}".encode(),
             f"WARC-Record-ID: <{record_id(f['url'], f['date'], page, digest)}>".encode(),
             f"WARC-Date: {w3c_date(f['date'])}".encode(), b"WARC-Target-URI: " + f["url"].encode(),
             f"WARC-IP-Address: {f['ip']}".encode(), f"WARC-Payload-Digest: sha1:{digest}".encode(),
             f"WARC-Block-Digest: sha1:{sha1_base32(block)}".encode(), b"Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}".encode()]
    if refers_to is not None:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>".encode()]
    return CRLF.join(lines) + CRLF + CRLF + block + CRLF + CRLF


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of uncompressed WARC bytes."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        first, *lines = data[at:end].split(CRLF)
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record at {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}
        n = int(fields["content-length"])
        yield fields, data[end + 4:end + 4 + n]
        at = end + 4 + n + 4


def gunzip_members(data: bytes) -> bytes:
    out = []
    while data:
        z = zlib.decompressobj(31)
        out.append(z.decompress(data))
        data = z.unused_data
    return b"".join(out)


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def arc_fields(url: str | None) -> dict[str, str]:
    url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "unknown:")
    return {"url": url, "ip": "0.0.0.0", "date": "20000101000000", "mime": "text/html"}


def http_block(page_id: int | None, payload: bytes) -> bytes:
    page = "" if page_id is None else str(page_id)
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\nX-Page-Id: {page}\r\n\r\n".encode() + payload


def _archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages (page_id, url, html, refers_id, refers_url, digest) to an ARC file, it to WARC, that to segments."""
    def segment(rows: list) -> pa.RecordBatch:
        version = 1 + number % 2
        arc = write_arc(f"{name}-{number:05}.arc", [(arc_fields(u), http_block(p, h)) for p, u, h, *_ in rows], version)
        members = []
        for (_, _, _, refers, refers_url, digest), record in zip(rows, read_arc(arc), strict=True):
            if refers is None:
                members.append(to_warc(record))
            else:
                of = arc_fields(refers_url)
                members.append(to_warc(record, record_id(of["url"], of["date"], str(refers), base64.b32encode(bytes.fromhex(digest)).decode())))
        data = b"".join(map(gzip_member, members))
        return pa.RecordBatch.from_pydict({"archive": [name], "segment": pa.array([number], pa.int32()), "data": pa.array([data], pa.binary())})

    # a task that is run again names its archive anew; only one attempt's segments are committed
    name, number, rows, size = uuid.uuid4().hex, 0, [], 0
    for batch in batches:
        for p, u, h, refers, refers_url, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.append((p, u, (h or "").encode(), refers, refers_url, digest))
            size += len(rows[-1][2])
            if size >= SEGMENT_BYTES:
                yield segment(rows)
                number, rows, size = number + 1, [], 0
    if rows:
        yield segment(rows)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Segments (archive, segment, data) of the WARC archives of all pages, written once."""
    stages = Stages(pages.sparkSession, "warc")
    pages = pages.select("page_id", "url", "html")
    digest = F.sha1(F.coalesce("html", F.lit("")))
    first = pages.select(digest.alias("sha"), F.struct("page_id", F.col("url")).alias("page")).groupBy("sha").agg(F.max("page").alias("page"), F.count("*").alias("n")).where("n > 1")
    first = stages.write(first.select("sha", F.col("page.page_id").alias("first_id"), F.col("page.url").alias("first_url")), "first")
    rows = pages.withColumn("own", digest).join(first.hint("merge"), F.col("own") == F.col("sha"), "left")
    later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.select("page_id", "url", "html", F.when(later, F.col("first_id")).alias("r"), F.when(later, F.col("first_url")).alias("ru"), "own")
    return stages.write(rows.mapInArrow(_archive, "archive string, segment int, data binary"), "segments")


def read_archives(segments: DataFrame) -> DataFrame:
    """A row per WARC record: page_id, record_id, record_type, refers_to_id, payload_digest, payload_bytes (null for a revisit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                out = {k: [] for k in ("page_id", "record_id", "record_type", "refers_to_id", "payload_digest", "payload_bytes")}
                for fields, block in read_warc(gunzip_members(data.as_py())):
                    head, payload = split_http(block)
                    page, kind = http_header(head, "X-Page-Id"), fields["warc-type"]
                    out["page_id"].append(int(page) if page else None)
                    out["record_id"].append(fields["warc-record-id"].strip("<>"))
                    out["record_type"].append(kind)
                    out["refers_to_id"].append(fields.get("warc-refers-to", "").strip("<>") or None)
                    out["payload_digest"].append(fields["warc-payload-digest"].removeprefix("sha1:"))
                    out["payload_bytes"].append(len(payload) if kind == "response" else None)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])
    return segments.select("data").mapInArrow(run, "page_id bigint, record_id string, record_type string, refers_to_id string, payload_digest string, payload_bytes bigint")


def pages_through_warc(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (page_id), read back from the archives."""
    stages = Stages(pages.sparkSession, "warc-records")
    records = stages.write(read_archives(archive_pages(pages)), "records")
    responses = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("of")).agg(
        F.first("page_id").alias("of_page"), F.first("payload_bytes").alias("of_bytes"))
    out = records.join(responses, F.col("refers_to_id") == F.col("of"), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "of_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("of_page").alias("refers_to"))
