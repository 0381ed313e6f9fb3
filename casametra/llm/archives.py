"""Legacy archive converter: ARC records to WARC records, and both as files.

An ARC file is a version block followed by records: a header line, as many bytes as
the line declares, and a line end. The fields of the line follow from the version:

* version 1: URL, IP address, date, content type, length;
* version 2: URL, IP address, date, content type, result code, checksum, location,
  offset, file name, length.

Each record becomes a WARC record with a made-up but repeatable identifier, the date as
a WARC timestamp, the type (``response``, or ``revisit`` for the repetition of a payload
of some size) and the payload's digest. Headers that ARC put into the record stay there.

Heads and payloads are bytes throughout, in whatever encoding a page has. Files are written
by Spark's text writer, which writes the bytes it is given, so that they arrive on any file
system and a lost task leaves nothing half-written. Files are read back whole, one per row,
and cut by declared lengths.

Defined cases: a null payload is empty, a null URL is ``about:blank``, and blanks in a
URL are percent-coded. A null key leaves its header empty; such a record is a response
only if no record with a key has its payload. Bytes of a header line that are no UTF-8 are
percent-coded. Repeated keys with one payload are all
responses. No pages, no records. A record whose bytes end before its declared length, or
whose payload does not have its digest, is an error.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads below this many bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: Bytes of an ARC file made of pages.
ARC_BYTES = 1 << 20
#: Records of a WARC file at most, so that a file stays readable in one piece.
RECORDS_PER_FILE = 20_000

#: Parts in which records with one payload meet its first one.
SALTS = 16

#: Fixed values of the formats.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER = "X-Page-Id"
REFERS_HEADER = "WARC-Refers-To-Page-Id"
BYTES_HEADER = "X-Payload-Bytes"


def line_text(line: bytes) -> str:
    """A header line as text; bytes that are no UTF-8 are percent-coded."""
    text = line.decode("utf-8", errors="surrogateescape")
    return re.sub("[\udc80-\udcff]", lambda m: f"%{ord(m[0]) - 0xDC00:02X}", text)


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes
    offset: int


# --- ARC --------------------------------------------------------------------


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file after its version block, by declared lengths."""
    version, at = "", 0
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        line_end = content.index(b"\n", at)
        fields = line_text(content[at:line_end]).rstrip("\r").split(" ")
        begin, length = line_end + 1, int(fields[-1])
        block = content[begin : begin + length]
        if len(block) < length:
            raise ValueError(f"ARC record at byte {at} ends before its {length} declared bytes")
        if not version:
            if not fields[0].startswith("filedesc:"):
                raise ValueError("an ARC file begins with a filedesc record")
            version = block.split(b" ", 1)[0].decode("ascii")
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            if len(fields) != len(ARC_FIELDS[version].split(" ")):
                raise ValueError(f"ARC header line at byte {at} does not have the fields of version {version}")
            yield ArcRecord(fields[0], fields[1], fields[2], fields[3], block, at)
        at = begin + length


def arc_version_block(version: str, name: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    head = f"filedesc://{name} 0.0.0.0 19960101000000 text/plain"
    if version == "2":
        head += f" 200 - - 0 {name}"
    return f"{head} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: str, url: str, date: str, block: bytes, name: str, offset: int) -> bytes:
    head = f"{url} 0.0.0.0 {date} text/html"
    if version == "2":
        head += f" 200 - - {offset} {name}"
    return f"{head} {len(block)}\n".encode() + block + b"\n"


def coded_url(url: str | None) -> str:
    """A URL without blanks or control characters."""
    if not url:
        return "about:blank"
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def page_archives(pages: DataFrame, date: str = "19960101000000") -> DataFrame:
    """ARC files of pages (page_id, url, html): name, content. Tasks alternate between versions."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version, number = "12"[task % 2], 0
        content = bytearray()
        for batch in batches:
            for key, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                name = f"pages-{task:06d}-{number:06d}.arc"
                content = content or bytearray(arc_version_block(version, name))
                payload = (html or "").encode()
                head = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"{KEY_HEADER}: {'' if key is None else key}\r\nContent-Length: {len(payload)}\r\n\r\n"
                )
                content += arc_record(version, coded_url(url), date, head.encode() + payload, name, len(content))
                if len(content) >= ARC_BYTES:
                    yield _one_file(name, content)
                    content, number = bytearray(), number + 1
        if content:
            yield _one_file(f"pages-{task:06d}-{number:06d}.arc", content)

    return pages.select("page_id", "url", "html").mapInArrow(make, "name string, content binary")


def _one_file(name: str, content: bytearray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([bytes(content)], pa.binary())], ["name", "content"])


# --- ARC to WARC ------------------------------------------------------------

RECORD_SCHEMA = (
    "record_id string, record_key long, uri string, ip string, date string, content_type string, "
    "http_head binary, payload binary, payload_bytes long, payload_digest string"
)


def _header(head: bytes, name: str) -> str:
    for line in line_text(head).split("\r\n"):
        if line.lower().startswith(name.lower() + ":"):
            return line.split(":", 1)[1].strip()
    return ""


def converted(archives: DataFrame) -> DataFrame:
    """WARC fields of all records in ARC files (name, content).

    The identifier is made from the file's name, the record's place and its URL. The date's
    14 digits become a WARC timestamp. The digest is over the payload, behind the HTTP head.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for record in parse_arc(content.as_buffer().to_pybytes()):
                    head, blank, payload = record.block.partition(b"\r\n\r\n")
                    if not blank:
                        head, payload = b"", record.block
                    head += blank
                    d = record.date
                    key = _header(head, KEY_HEADER)
                    rows.append(
                        (
                            f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{record.offset} {record.url}')}>",
                            int(key) if key else None, record.url, record.ip,
                            f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                            record.content_type, head, payload, len(payload), hashlib.sha256(payload).hexdigest(),
                        )
                    )
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], FIELDS
                    )

    return archives.select("name", "content").mapInArrow(convert, RECORD_SCHEMA)


FIELDS = [f.split(" ")[0] for f in RECORD_SCHEMA.split(", ")]
_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
TYPES = [_ARROW[f.split(" ")[1]] for f in RECORD_SCHEMA.split(", ")]


def with_types(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds record_type and refers_to: revisits name the smallest key with their payload."""
    repeated = (
        records.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("record_key").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
        .drop("_n")
    )
    # a small payload meets nothing, under its record's own key; a payload that many records
    # have meets its first record in several parts
    large = F.col("payload_bytes") >= min_bytes
    parts = repeated.select(
        F.col("payload_digest").alias("_key"), "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    joined = records.withColumns({
        "_key": F.when(large, F.col("payload_digest")).otherwise(F.col("record_id")),
        "_salt": F.when(large, F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")).otherwise(0),
    }).join(parts, ["_key", "_salt"], "left")
    revisit = large & F.col("_first").isNotNull() & ~F.col("record_key").eqNullSafe(F.col("_first"))
    return joined.select(
        "*",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    ).drop("_first", "_key", "_salt")


# --- WARC files -------------------------------------------------------------


def warc_text(records: DataFrame) -> DataFrame:
    """Each typed record as a WARC record, less the very last line end."""
    revisit = F.col("record_type") == "revisit"
    block = F.concat("http_head", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    end = "\r\n"
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type",
        F.lit("\r\nWARC-Record-ID: "), "record_id",
        F.lit("\r\nWARC-Target-URI: "), "uri",
        F.lit("\r\nWARC-Date: "), "date",
        F.lit("\r\nWARC-IP-Address: "), "ip",
        F.lit("\r\nWARC-Payload-Digest: sha256:"), "payload_digest",
        F.lit(f"\r\n{BYTES_HEADER}: "), F.col("payload_bytes").cast("string"),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n" + REFERS_HEADER + ": "),
                F.col("refers_to").cast("string"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(end + end),
    )
    # bytes as they are: the cast to text checks and changes nothing
    return records.select(F.concat(head.cast("binary"), block, F.lit(b"\r\n\r")).cast("string").alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Typed records as gzip-compressed WARC files."""
    warc_text(records).write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, with lower-case names, and block of each WARC record."""
    at = 0
    while at < len(content):
        head_end = content.find(b"\r\n\r\n", at)
        if head_end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = line_text(content[at:head_end]).split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        begin = head_end + 4
        end = begin + int(fields["content-length"])
        if content[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"WARC record at byte {at} does not end where it declares")
        yield fields, content[begin:end]
        at = end + 4


def unzipped(content: bytes) -> bytes:
    """The content of all gzip members; plain content stays as it is."""
    out = []
    while content.startswith(b"\x1f\x8b"):
        stream = zlib.decompressobj(31)
        out.append(stream.decompress(content))
        content = stream.unused_data
    return b"".join(out) if out else content


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files in a folder, payloads checked against their digests."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse_warc(unzipped(content.as_buffer().to_pybytes())):
                    head, blank, payload = block.partition(b"\r\n\r\n")
                    head += blank
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    kind = fields["warc-type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
                    key, refers = _header(head, KEY_HEADER), fields.get(REFERS_HEADER.lower())
                    rows.append(
                        (
                            fields["warc-record-id"], int(key) if key else None, fields["warc-target-uri"], fields["warc-date"],
                            kind, int(refers) if refers else None, digest,
                            len(payload) if kind == "response" else int(fields[BYTES_HEADER.lower()]),
                            payload if kind == "response" else None,
                        )
                    )
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), READ_TYPES, strict=True)], READ_FIELDS
                    )

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, READ_SCHEMA)


READ_SCHEMA = (
    "record_id string, record_key long, uri string, date string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)
READ_FIELDS = [f.split(" ")[0] for f in READ_SCHEMA.split(", ")]
READ_TYPES = [_ARROW[f.split(" ")[1]] for f in READ_SCHEMA.split(", ")]


def archive_pages(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages through ARC files into WARC files at ``path``, and the records read back from there."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    write_warc(with_types(converted(page_archives(pages)), min_bytes), path)
    return read_warc(pages.sparkSession, path)
