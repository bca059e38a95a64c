"""Conversion of legacy ARC archives to WARC archives, and reading of both.

An ARC archive starts with a version block; its version decides the fields of every header line: five in version 1
(URL, address, date, type, length), ten in version 2 (result code, checksum, location, offset and file name come
before the length). Content follows by its declared length, so nothing inside it can pass for a header.

The converter writes one WARC record per ARC record: ``response``, or ``revisit`` of the record with the same payload
that has the smallest key. Record ids come from archive and position, so a rerun task writes the same ids; dates
from the 14-digit ARC date; digests are SHA-1 in base32.

Archives are written by Spark's text writer, gzipped, and read as binary files: an archive is parsed in one task, so its
size is the unit of memory. A file has at most ``records_per_file`` records and about ``FILE_BYTES`` before
compression: where that many records of one size would be more, the larger records go to files of their own with
fewer in each. Foreign archives over Spark's limit for binary files (2 GB) must be cut first. Lines that are no header end
the parsing of that archive with an error. Null html is an empty payload, repeated rows are records of their own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.session import cut_lineage, scratch_path

RECORDS_PER_FILE = 4_000
FILE_BYTES = 1_000_000_000
GZIP_STEP = 1 << 16
#: Header fields by version.
ARC_FIELDS = {
    1: ("url", "address", "date", "type", "length"),
    2: ("url", "address", "date", "type", "code", "checksum", "location", "offset", "file", "length"),
}
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
END = "\r\n\r\n"

ARC_RECORD = (
    "archive string, position long, url string, address string, date string, type string, http_head binary, "
    "payload binary, payload_bytes long, payload_digest string, page_id string"
)
WARC_RECORD = (
    "archive string, record_type string, record_id string, target string, date string, page_id string, "
    "refers_to string, payload_bytes long, payload_digest string, payload binary"
)


class ArchiveError(ValueError):
    """An archive that does not follow its declared lengths or fields."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def unzipped(data: bytes) -> bytes:
    """All gzip members of an archive, or the data as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts, whole, at = [], memoryview(data), 0
    while data[at:at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        # by steps, so that the rest of the archive is not copied once per member
        while not member.eof and at < len(data):
            parts.append(member.decompress(whole[at:at + GZIP_STEP]))
            at += min(GZIP_STEP, len(data) - at)
        if not member.eof:
            raise ArchiveError("a gzip member is cut off")
        at -= len(member.unused_data)
    return b"".join(parts)


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Position, header fields and content of every record after the version block; an empty file has none."""
    if not data:
        return
    line, at = _line(data, 0)
    if not line.startswith(b"filedesc://"):
        raise ArchiveError("no version block")
    length = int(line.rsplit(b" ", 1)[1])
    version = int(data[at:at + length].split(b" ", 1)[0])
    fields = ARC_FIELDS.get(version)
    if fields is None:
        raise ArchiveError(f"unknown version {version}")
    at = _after(data, at + length)
    while at < len(data):
        position = at
        line, at = _line(data, at)
        # a URL may hold spaces, other fields don't
        values = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if len(values) != len(fields) or not values[-1].isdigit():
            raise ArchiveError(f"no header line at {position}")
        header = dict(zip(fields, values, strict=True))
        end = at + int(header["length"])
        if end > len(data):
            raise ArchiveError(f"the record at {position} is cut off")
        yield position, header, data[at:end]
        at = _after(data, end)


def _line(data: bytes, at: int) -> tuple[bytes, int]:
    end = data.find(b"\n", at)
    if end < 0:
        raise ArchiveError(f"no line at {at}")
    return data[at:end].rstrip(b"\r"), end + 1


def _after(data: bytes, at: int) -> int:
    """Past the line ends between two records."""
    while at < len(data) and data[at] in b"\r\n":
        at += 1
    return at


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload; content without a head is all payload."""
    if content.startswith(b"HTTP/"):
        end = content.find(b"\r\n\r\n")
        if end >= 0:
            return content[:end + 4], content[end + 4:]
    return b"", content


def http_field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + name + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else None


def write_arc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "20010203040506",
    records_per_file: int = RECORDS_PER_FILE, version: int = 2,
) -> None:
    """ARC archives of a page table, as text files with one version block each.

    Null html is an empty payload, a null URL ``unknown:``; a null key writes no key field.
    """
    field = lambda c, none: F.regexp_replace(F.coalesce(c.cast("string"), F.lit(none)), "[\\r\\n\\t ]", "%20")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(
            F.col(key).isNotNull(), F.concat(F.lit("X-Page-Id: "), field(F.col(key), ""), F.lit("\r\n"))
        ).otherwise(""),
        F.lit("\r\n"),
    )
    content = F.concat(head, F.coalesce(F.col(html), F.lit("")))
    more = "200 - - 0 pages.arc " if version == 2 else ""
    record = F.concat(
        field(F.col(url), "unknown:"), F.lit(f" 0.0.0.0 {date} text/html {more}"),
        F.octet_length(content).cast("string"), F.lit("\n"), content,
    )
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (url, html)), F.lit(1024))
    largest = pages.agg(F.max(size)).first()[0] or 0
    records = pages.select(record.alias("value"), size.alias("size"))
    _with_heads(records, _arc_head(version, date), "\n", path, records_per_file, largest)


def _arc_head(version: int, date: str) -> str:
    block = f"{version} 0 affinis\n{ARC_TITLES[version]}\n"
    more = "200 - - 0 pages.arc " if version == 2 else ""
    return f"filedesc://pages.arc 0.0.0.0 {date} text/plain {more}{len(block)}\n{block}"


def _with_heads(records: DataFrame, head: str, end: str, path: str, records_per_file: int, largest: int) -> None:
    """Text files of rows (value, size), each begun by ``head``; ``largest`` is the largest size, in bytes."""
    small = FILE_BYTES // records_per_file
    _text_files(records if largest <= small else records.where(F.col("size") <= small), head, end, path, records_per_file)
    if largest > small:
        _text_files(records.where(F.col("size") > small), head, end, path, max(1, FILE_BYTES // largest))


def _text_files(records: DataFrame, head: str, end: str, path: str, records_per_file: int) -> None:
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.col("number") % records_per_file == 0
    value = F.when(first, F.concat(F.lit(head + end), "value")).otherwise(F.col("value"))
    (
        records.withColumn("number", number).select(value.alias("value")).write.mode("append").option("lineSep", end)
        .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)
    )


def read_arc(spark, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all ARC archives under ``path`` (``ARC_RECORD``); ``payload`` is null unless asked for."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, content in _files(batches):
            rows = []
            for position, header, block in arc_records(unzipped(content)):
                head, payload = split_http(block)
                rows.append((
                    name, position, header["url"], header["address"], header["date"], header["type"], head,
                    payload if with_payload else None, len(payload), sha1_base32(payload), http_field(head, b"X-Page-Id"),
                ))
            yield _batch(rows, ARC_RECORD)

    return files.mapInArrow(parse, ARC_RECORD)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(*batch.columns, strict=True):
            yield path.as_py().rsplit("/", 1)[1], content.as_py()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def convert(spark, arc_path: str, warc_path: str, least_revisit_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """WARC archives below ``warc_path`` of the ARC archives below ``arc_path``.

    Of records with equal payloads of ``least_revisit_bytes`` or more the one with the smallest key is the response,
    the others revisit it; of equal keys the first by archive and position. Records without a key come last.
    Digests and keys decide, without the payloads; then each payload moves once, to its verdict.
    """
    narrow = cut_lineage(read_arc(spark, arc_path, with_payload=False).drop("payload", "http_head"))
    # numbers in their own order, other keys after them as strings
    order = F.struct(
        F.col("page_id").isNull().alias("none"), F.expr("try_cast(page_id as bigint)").isNull().alias("word"),
        F.expr("try_cast(page_id as bigint)").alias("number"), "page_id", "archive", "position",
    )
    same = ["payload_digest", "payload_bytes"]
    firsts = narrow.where(F.col("payload_bytes") >= least_revisit_bytes).groupBy(*same).agg(F.min(order).alias("first"))
    judged = narrow.join(firsts, same, "left").select(
        "archive", "position",
        F.when(
            (F.col("first.archive") != F.col("archive")) | (F.col("first.position") != F.col("position")), F.col("first")
        ).alias("first"),
    )
    records = read_arc(spark, arc_path).join(judged, ["archive", "position"])
    record_id = lambda archive, position: F.concat(
        F.lit("<urn:uuid:"), _uuid(F.md5(F.concat_ws("#", archive, position.cast("string")))), F.lit(">")
    )
    revisit = F.col("first").isNotNull()
    block = F.concat("http_head", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    line = lambda name, value: F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))
    digits = F.concat(F.col("date"), F.expr("substring('00000101000000', length(date) + 1)"))
    digits = F.when(F.col("date").rlike("^[0-9]{4,14}$"), digits).otherwise("19700101000000")
    stamp = F.regexp_replace(digits, "^(....)(..)(..)(..)(..)(..)$", "$1-$2-$3T$4:$5:$6Z")
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("archive"), F.col("position"))),
        line("WARC-Target-URI", F.col("url")), line("WARC-IP-Address", F.col("address")), line("WARC-Date", stamp),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("WARC-Refers-To", F.when(revisit, record_id(F.col("first.archive"), F.col("first.position")))),
        line("WARC-Profile", F.when(
            revisit, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        )),
        line("X-Payload-Bytes", F.col("payload_bytes").cast("string")), line("X-Key", F.col("page_id")),
        line("X-Refers-To-Key", F.when(revisit, F.col("first.page_id"))),
        line("Content-Type", F.when(
            F.octet_length("http_head") > 0, F.lit("application/http; msgtype=response")
        ).otherwise(F.col("type"))),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    # the heads of HTTP and WARC, and what a URL adds to them
    size = F.col("payload_bytes") + F.octet_length("url") + 4096
    largest = narrow.agg(F.max(size)).first()[0] or 0
    _with_heads(
        records.select(F.concat(head.cast("binary"), block).cast("string").alias("value"), size.alias("size")),
        _warc_head(), END, warc_path, records_per_file, largest,
    )


def _uuid(hexes: Column) -> Column:
    return F.regexp_replace(hexes, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _warc_head() -> str:
    block = "software: affinis\r\nformat: WARC File Format 1.0\r\n"
    return (
        f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, block)}>\r\n"
        "WARC-Date: 2001-02-03T04:05:06Z\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(block)}\r\n\r\n{block}"
    )


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record."""
    at = 0
    while at < len(data):
        line, after = _line(data, at)
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no record at {at}")
        end = data.find(b"\r\n\r\n", after)
        if end < 0:
            raise ArchiveError(f"the header at {at} is cut off")
        header = {}
        for field in data[after:end].decode("utf-8", "replace").split("\r\n"):
            name, _, value = field.partition(":")
            header[name.strip().lower()] = value.strip()
        start = end + 4
        stop = start + int(header["content-length"])
        if stop > len(data):
            raise ArchiveError(f"the record at {at} is cut off")
        yield header, data[start:stop]
        at = _after(data, stop)


def read_warc(spark, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all WARC archives under ``path`` (``WARC_RECORD``), without the archives' own information.

    Size and digest of a response are those of the payload as read, checked against its header; a revisit has those
    that its header states.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, content in _files(batches):
            rows = []
            for header, block in warc_records(unzipped(content)):
                kind = header["warc-type"]
                if kind == "warcinfo":
                    continue
                payload = split_http(block)[1] if header.get("content-type", "").startswith("application/http") else block
                stated = header.get("warc-payload-digest", "").removeprefix("sha1:")
                size, digest = int(header.get("x-payload-bytes", len(payload))), stated
                if kind == "response":
                    size, digest = len(payload), sha1_base32(payload)
                    if stated and stated != digest:
                        raise ArchiveError(f"{header['warc-record-id']} has another payload than its digest says")
                rows.append((
                    name, kind, header["warc-record-id"], header.get("warc-target-uri"), header.get("warc-date"),
                    header.get("x-key"), header.get("x-refers-to-key"), size, digest,
                    payload if with_payload and kind == "response" else None,
                ))
            yield _batch(rows, WARC_RECORD)

    return files.mapInArrow(parse, WARC_RECORD)


def archive_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as ARC archives, those as WARC archives, and the WARC records read again, without payloads."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, key, url, html)
    convert(spark, arc, warc)
    return read_warc(spark, warc, with_payload=False)
