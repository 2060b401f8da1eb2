"""Legacy web archives (ARC) and their conversion to WARC.

ARC records begin with one line of space-separated fields whose number depends on
the version the file declares, the last field being the length of what follows.
The converter reads records by these declared lengths and synthesises what WARC
asks for: record identifiers, timestamps, record types and digests.  Records with
a payload that an earlier record has become revisits of it.

Archives are written and read by Spark only, so they may lie in any store it
knows; a file stays near ``FILE_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, forget_shuffles, text_bytes
from gaugeworks.sources.scratch import scratch_path, written

FILE_BYTES = 8 << 20
# The field names that the version block of an ARC file declares.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ID_HEADER = "X-Page-Id"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ARC ------------------------------------------------------------------------------


def _field(value: str | None) -> str:
    """A header field: no white space, never empty."""
    cleaned = re.sub(r"\s", lambda found: f"%{ord(found.group()):02X}", value or "")
    return cleaned or "-"


def arc_record(version: int, url: str | None, ip: str, date: str, mime: str, status: int, body: bytes) -> bytes:
    fields = [_field(url), ip, date, mime]
    if version == 2:
        fields += [str(status), "-", "-", "0", "-"]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """The first record of an ARC file: it declares the version and its header fields."""
    body = f"{version} 0 gaugeworks\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", 200, body)


def read_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file, by declared lengths.

    The version block decides the fields of the lines after it; without one,
    version 1 is assumed.  A line that doesn't fit the version ends the file,
    as nothing after it can be found by length.
    """
    at, fields = 0, ARC_FIELDS[1].split(" ")
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            return
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        begins_file = values[0].startswith("filedesc:")
        if begins_file and len(values) in (5, 10):
            fields = ARC_FIELDS[1 if len(values) == 5 else 2].split(" ")
        if len(values) != len(fields) or not values[-1].isdigit():
            return
        length = int(values[-1])
        body = data[end + 1 : end + 1 + length]
        if len(body) < length:
            return
        at = end + 1 + length
        if begins_file:
            declared = body.decode("utf-8", "replace").split("\n")
            if len(declared) > 1 and declared[1].strip() in ARC_FIELDS.values():
                fields = declared[1].strip().split(" ")
        yield dict(zip(fields, values)) | {"body": body, "filedesc": begins_file}


def warc_date(date: str) -> str:
    """Fourteen digits, or the leading part of them, as a WARC timestamp."""
    digits = re.match(r"\d{0,14}", date or "").group()
    full = digits + "19700101000000"[len(digits) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def http_parts(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head, with its closing empty line, and payload; no head where the body is not HTTP."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    ends = [(body.find(mark), len(mark)) for mark in (b"\r\n\r\n", b"\n\n")]
    found = min(((at, size) for at, size in ends if at >= 0), default=None)
    if found is None:
        return body, b""
    return body[: found[0] + found[1]], body[found[0] + found[1] :]


def http_header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n")[1:]:
        key, mark, value = line.partition(b":")
        if mark and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def _id_of(head: bytes, name: str) -> str | None:
    """An id in its header; that of ``write_arc`` is percent-encoded, others are taken as they are."""
    value = http_header(head, name)
    return unquote(value) if value is not None and name == ID_HEADER else value


# --- WARC -----------------------------------------------------------------------------


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.0", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Headers (lower-case names) and block of each record, by declared lengths."""
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        if at < 0:
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", 0))
        yield headers, data[end + 4 : end + 4 + length]
        at = end + 4 + length


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


# --- Spark ----------------------------------------------------------------------------


def _write_records(records: DataFrame, path: str) -> None:
    """Rows of bytes, end to end, as gzip files.  The text writer ends each row with the newline it lacks.

    Archives are read back soon and often: the fastest level takes a little more space and much less time.
    """
    fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    records.select(F.col("record").cast("string")).write.options(**fast).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _plain(content: bytes) -> bytes:
    """The bytes of a file, of one or more gzip members."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def write_arc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "20240101000000",
) -> None:
    """Write a page per row as ARC records, versions 1 and 2 by turns of the output files.

    A null html is an empty payload, a null url is ``-``; the id travels
    percent-encoded in an HTTP header, which a null id lacks.
    """
    size = pages.select(F.sum(F.octet_length(text_bytes(html_col)) + 300)).first()[0] or 0
    rows = pages.select(
        ref(id_col).cast("string").alias("id"), ref(url_col).cast("string").alias("url"), text_bytes(html_col).alias("html")
    ).repartition(max(1, size // FILE_BYTES))
    schema = pa.schema([("record", pa.binary())])

    def recorded(batches: Batches) -> Batches:
        def records():
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            version, begun = 1 + part % 2, False
            for batch in batches:
                for doc, url, html in zip(*(batch.column(name).to_pylist() for name in ("id", "url", "html"))):
                    if not begun:
                        yield (arc_version_block(version, f"part-{part}.arc", date)[:-1],)
                        begun = True
                    named = "" if doc is None else f"{ID_HEADER}: {quote(doc, safe='')}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n{named}\r\n"
                    yield (arc_record(version, url, "0.0.0.0", date, "text/html", 200, head.encode() + html)[:-1],)

        yield from batches_of(schema, records())

    _write_records(rows.mapInArrow(recorded, "record binary"), path)


_ARC_ROW = pa.schema(
    [
        ("seen", pa.string()),
        ("url", pa.string()),
        ("ip", pa.string()),
        ("date", pa.string()),
        ("mime", pa.string()),
        ("digest", pa.string()),
        ("order", pa.string()),
        ("record_id", pa.string()),
        ("payload_bytes", pa.int64()),
        ("body", pa.binary()),
    ]
)
_ARC_TYPES = (
    "seen string, url string, ip string, date string, mime string, digest string, order string, record_id string, "
    "payload_bytes long, body binary"
)


def arc_rows(spark: SparkSession, path: str, order_header: str = ID_HEADER, with_body: bool = True) -> DataFrame:
    """One row per ARC record other than version blocks; ``seen`` names file and place."""

    def parsed(batches: Batches) -> Batches:
        def rows():
            for batch in batches:
                for file, content in zip(*(column.to_pylist() for column in batch.columns)):
                    for place, record in enumerate(read_arc(_plain(content))):
                        if record["filedesc"]:
                            continue
                        head, payload = http_parts(record["body"])
                        order = _id_of(head, order_header)
                        seen = f"{file.rpartition('/')[2]}:{place}"
                        yield (
                            seen,
                            record["URL"],
                            record["IP-address"],
                            record["Archive-date"],
                            record["Content-type"],
                            payload_digest(payload),
                            order,
                            _record_id(record["URL"], record["Archive-date"], seen),
                            len(payload),
                            record["body"] if with_body else None,
                        )

        yield from batches_of(_ARC_ROW, rows(), 500)

    return _files(spark, path).mapInArrow(parsed, _ARC_TYPES)


def arc_to_warc(
    spark: SparkSession, arc_path: str, warc_path: str, order_header: str = ID_HEADER, least_bytes: int = 0, order_type: str = "long"
) -> None:
    """Convert the ARC files below ``arc_path`` to WARC files below ``warc_path``.

    HTTP records become ``response`` records, others ``resource``; of the
    records with equal payloads of at least ``least_bytes`` bytes, the first by
    the value of type ``order_type`` in ``order_header`` (none: last; ties: by file and place) stays
    and the others become ``revisit`` records that keep their HTTP head and
    refer to it.  Identifiers are name-based, so a repeated run gives the same.
    """
    keys = arc_rows(spark, arc_path, order_header, with_body=False)
    order = F.col("order").try_cast(order_type)
    place = F.struct(order.isNull(), order, "seen")
    firsts = (
        keys.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min_by(F.struct("record_id", "url", "date"), place).alias("first"), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .select("digest", "first")
    )
    rows = arc_rows(spark, arc_path, order_header).join(firsts, "digest", "left")

    schema = pa.schema([("record", pa.binary())])

    def converted(batches: Batches) -> Batches:
        def records():
            for batch in batches:
                for row in batch.to_pylist():
                    first = row["first"]
                    revisit = first is not None and first["record_id"] != row["record_id"]
                    head, payload = http_parts(row["body"])
                    revisit = revisit and bool(head) and row["payload_bytes"] >= least_bytes
                    block = head if revisit else row["body"]
                    headers = [
                        ("WARC-Type", "revisit" if revisit else "response" if head else "resource"),
                        ("WARC-Record-ID", row["record_id"]),
                        ("WARC-Date", warc_date(row["date"])),
                        ("WARC-Target-URI", row["url"]),
                        ("WARC-IP-Address", row["ip"]),
                        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
                        ("Content-Type", "application/http; msgtype=response" if head else row["mime"]),
                    ]
                    if revisit:
                        headers += [
                            ("WARC-Profile", REVISIT_PROFILE),
                            ("WARC-Refers-To", first["record_id"]),
                            ("WARC-Refers-To-Target-URI", first["url"]),
                            ("WARC-Refers-To-Date", warc_date(first["date"])),
                        ]
                    # The writer adds the last newline.
                    yield (warc_record(headers, block)[:-1],)

        yield from batches_of(schema, records(), 500)

    _write_records(rows.mapInArrow(converted, "record binary"), warc_path)


def warc_rows(spark: SparkSession, path: str, id_header: str = ID_HEADER) -> DataFrame:
    """Per WARC record: id, ``record_id, record_type, payload_bytes, payload_digest, refers_to_record``.

    A response's size and digest are those of the payload read; a revisit's
    come from its own headers, as its payload is elsewhere.
    """
    schema = pa.schema(
        [
            ("id", pa.string()),
            ("record_id", pa.string()),
            ("record_type", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("refers_to_record", pa.string()),
        ]
    )

    def parsed(batches: Batches) -> Batches:
        def rows():
            for batch in batches:
                for content in batch.column("content").to_pylist():
                    for headers, block in read_warc(_plain(content)):
                        head, payload = http_parts(block)
                        revisit = headers.get("warc-type") == "revisit"
                        size = int(http_header(head, "Content-Length") or 0) if revisit else len(payload)
                        digest = headers.get("warc-payload-digest", "").partition(":")[2]
                        yield (
                            _id_of(head, id_header),
                            headers.get("warc-record-id"),
                            headers.get("warc-type"),
                            size,
                            digest if revisit else payload_digest(payload),
                            headers.get("warc-refers-to"),
                        )

        yield from batches_of(schema, rows(), 5_000)

    return _files(spark, path).mapInArrow(
        parsed,
        "id string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to_record string",
    )


def convert_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Pages as ARC files, converted to WARC files, read back.

    ``id_col, payload_bytes, payload_digest, record_type, refers_to``, a row per
    page.  Of equal payloads (empty and null ones are equal too) the smallest
    id is the response, and ``refers_to`` of the others is that id.  A null id
    comes after all others and stays null; rows that repeat an id are records
    of their own; no rows, no records.  Other columns are not looked at.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    forget_shuffles(spark)
    arc_to_warc(spark, arc, warc, order_type=pages.schema[id_col].dataType.simpleString())
    forget_shuffles(spark)
    # Archives are parsed once; what is looked up is narrow.
    found = written(warc_rows(spark, warc), "warc-rows", compression="zstd")
    named = found.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_record"), F.col("id").alias("refers_to")
    )
    kind = pages.schema[id_col].dataType
    return found.join(named, "refers_to_record", "left").select(
        F.col("id").try_cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast(kind).alias("refers_to"),
    )
