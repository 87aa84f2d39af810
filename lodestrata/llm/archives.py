"""WARC archives by way of a converter for legacy ARC files.

The converter reads an ARC file (plain, or gzip members), its version block with the fields that it declares, and
cuts each record by its declared length. Header lines are read from the date outwards, so urls and content types may
hold spaces. For each record it synthesises the equivalent WARC record: a status line makes it a response (or a
revisit), anything else (dns lookups, bare files) a resource of its declared type; identifier, timestamp, address,
block and payload digests follow from the record itself; the version block becomes a warcinfo record that the others
name. Heads of HTTP messages may end lines with LF alone, and lines without a colon are left as they are.

``archive`` writes a record for every page by way of ARC captures and reads the archives back. Among records with
equal payloads of at least ``min_bytes`` bytes, the one with the greatest page_id is a response; the others are
revisits that refer to it. Payloads meet by digest and length, pre-aggregated before the shuffle. Payloads that make
up ``1 / HOT`` or more of the repeated rows are at most ``HOT``, so these few rows (digest, target) are broadcast, and
their pages are dealt by page; no other key holds more. Archives are rows of gzip members of at most about
``ARCHIVE_BYTES`` (or one record), written as Parquet in the shared folder, so any store that Spark writes will do;
``export`` copies them to files, and ``convert_files`` converts a table of ARC files.

Defined results: a null html is an empty payload. A null url is recorded as ``urn:page:<id>``; urls of any length are
kept whole. Rows that repeat a page_id with one payload are all of one type: with the greatest page_id each is a
response. Captures equal in every byte share one identifier. A null page_id is less than any other; it stays null.
Extra columns are not archived. An empty table gives no archive and no rows. ARC data that ends before a declared
length, or a header line without date and length, is an error that names the byte.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import ipaddress
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm import _scratch

ARCHIVE_BYTES = 4 << 20
MIN_BYTES = 0
#: Payloads of which each makes up 1 / HOT of the repeated rows, at most so many, are broadcast.
HOT = 200
#: Pages carry no date of capture; every record gets this one.
CAPTURED = "20240101000000"
#: Pages carry no address either.
NO_ADDRESS = "0.0.0.0"
LEVEL = 4

#: Fields of an ARC record's header line by version, and their names in version blocks (fixed by the format).
ARC_FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
DECLARED = {
    "url": "URL", "ip": "IP-address", "date": "Archive-date", "type": "Content-type", "result": "Result-code",
    "checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename", "length": "Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class ArcRecord:
    """A record of an ARC file: its header fields and its declared bytes."""

    fields: dict[str, str]
    content: bytes


@dataclass
class ArcVersion:
    """An ARC file's version block: version, origin, the names of the fields of its records, and its own header fields."""

    version: str
    origin: str
    names: tuple[str, ...]
    fields: dict[str, str]


def write_arc(captures: Iterable[tuple[str, str, bytes]], version: str = "1", date: str = CAPTURED, ip: str = NO_ADDRESS) -> bytes:
    """An uncompressed ARC file of (url, content type, content)."""
    names = ARC_FIELDS[version]
    block = f"{version} 0 -\n{' '.join(DECLARED[n] for n in names)}\n".encode()

    def header(url: str, kind: str, content: bytes) -> bytes:
        values = {"url": url, "ip": ip, "date": date, "type": kind, "length": str(len(content))}
        return " ".join(values.get(n, "-") for n in names).encode() + b"\n"

    out = [header("filedesc://pages.arc", "text/plain", block), block, b"\n"]
    for url, kind, content in captures:
        out += [header(url, kind, content), content, b"\n"]
    return b"".join(out)


def _line(line: bytes, names: tuple[str, ...], at: int) -> dict[str, str]:
    """The fields of a header line: the date (8 to 17 digits) stands after url and address, the fields behind the type hold no spaces."""
    text = line.decode("utf-8", "surrogateescape").rstrip("\r")
    behind = len(names) - 4
    found = re.fullmatch(r"(.*) (\S+) (\d{8,17}) (.*)" + r" (\S+)" * (behind - 1) + r" (\d+)", text) if behind > 0 else None
    if not found:
        raise ValueError(f"header line at byte {at} has no date and length: {text[:200]!r}")
    return dict(zip(names, found.groups()))


def _content(data: bytes, start: int, fields: dict[str, str]) -> bytes:
    end = start + int(fields["length"])
    if end > len(data):
        raise ValueError(f"record at byte {start} is shorter than declared")
    return data[start:end]


def read_version(data: bytes) -> tuple[ArcVersion, int]:
    """(the version block of an uncompressed ARC file, the byte behind it).

    The block's own header line has the layout of its version, which only the block itself tells: its length is the
    line's last word in both.
    """
    end = data.find(b"\n")
    if not data.startswith(b"filedesc:") or end < 0:
        raise ValueError("no version block at byte 0")
    line = data[:end]
    length = line.split()[-1]
    if not length.isdigit():
        raise ValueError("the version block's header line has no length")
    block = _content(data, end + 1, {"length": length.decode()})
    lines = block.decode("utf-8", "replace").splitlines()
    version, _, origin = (lines[0].split(None, 2) + ["", "", ""])[:3] if lines else ("", "", "")
    if version not in ARC_FIELDS:
        raise ValueError(f"version {version!r} is none of {sorted(ARC_FIELDS)}")
    short = {v.lower(): k for k, v in DECLARED.items()}
    declared = tuple(short.get(name.lower(), name.lower()) for name in lines[1].split()) if len(lines) > 1 else ()
    names = declared if declared[:4] == ARC_FIELDS["1"][:4] and declared[-1] == "length" else ARC_FIELDS[version]
    return ArcVersion(version, origin, names, _line(line, ARC_FIELDS["1" if len(line.split()) <= 5 else "2"], 0)), end + 1 + len(block)


def plain(data: bytes) -> bytes:
    """ARC data without gzip."""
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, in order, without its version block."""
    data = plain(data)
    version, at = read_version(data)
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        fields = _line(data[at:end], version.names, at)
        content = _content(data, end + 1, fields)
        at = end + 1 + len(content)
        yield ArcRecord(fields, content)


def digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(name: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name).digest()[:16], version=5)}>"


def record_id(record: ArcRecord) -> str:
    """A stable identifier of a record, from its header fields and bytes."""
    named = " ".join(f"{k}={v}" for k, v in record.fields.items() if k not in ("offset", "filename"))
    return _urn(named.encode("utf-8", "surrogateescape") + b"\n" + hashlib.sha1(record.content).digest())


def _http(content: bytes) -> tuple[bytes, dict[str, str], bytes] | None:
    """An HTTP message's head, its fields (names in lower case) and its payload; None if there is no status line."""
    if not re.match(rb"HTTP/\d", content):
        return None
    end = re.search(rb"\r?\n\r?\n", content)
    at = end.end() if end else len(content)
    fields: dict[str, str] = {}
    for line in content[:at].decode("latin-1").splitlines()[1:]:
        name, colon, value = line.partition(":")
        if colon and name == name.strip():
            fields.setdefault(name.lower(), value.strip())
    return content[:at], fields, content[at:]


def warc_date(date: str) -> str:
    """A WARC timestamp of an ARC date; what the date lacks is zero."""
    d = date[:14].ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _address(ip: str) -> list[str]:
    try:
        address = ipaddress.ip_address(ip)
    except ValueError:
        return []
    return [] if address.is_unspecified else [f"WARC-IP-Address: {address}"]


def _record(lines: list[str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *lines, f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r\n"


def to_warcinfo(version: ArcVersion) -> tuple[str, bytes]:
    """(identifier, the warcinfo record) of an ARC file's version block."""
    name = version.fields["url"].removeprefix("filedesc://")
    facts = {"software": "lodestrata", "format": "WARC File Format 1.1", "description": f"converted from ARC version {version.version}", "isPartOf": name}
    facts |= {"publisher": version.origin} if version.origin.strip("- ") else {}
    block = "".join(f"{k}: {v}\r\n" for k, v in facts.items()).encode("utf-8", "surrogateescape")
    own = _urn(repr(version).encode("utf-8", "surrogateescape"))
    lines = ["WARC-Type: warcinfo", f"WARC-Record-ID: {own}", f"WARC-Date: {warc_date(version.fields['date'])}", f"WARC-Filename: {name}", *_address(version.fields["ip"])]
    return own, _record([*lines, "Content-Type: application/warc-fields"], block)


def to_warc(record: ArcRecord, target: ArcRecord | None, info: str | None = None) -> bytes:
    """The WARC record of an ARC record; target: the response with an equal payload that it revisits, info: its warcinfo's identifier."""
    http = _http(record.content)
    payload = http[2] if http else record.content
    revisits = target is not None and http is not None
    kind = "revisit" if revisits else "response" if http else "resource"
    own = f"sha1:{digest(payload)}"
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(record)}",
        f"WARC-Target-URI: {record.fields['url'].replace(' ', '%20')}",
        f"WARC-Date: {warc_date(record.fields['date'])}",
        f"WARC-Payload-Digest: {own}",
        *_address(record.fields["ip"]),
        *([f"WARC-Warcinfo-ID: {info}"] if info else []),
        f"Content-Type: {'application/http; msgtype=response' if http else record.fields['type']}",
    ]
    if revisits:
        lines += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: {record_id(target)}",
            f"WARC-Refers-To-Target-URI: {target.fields['url'].replace(' ', '%20')}",
            f"WARC-Refers-To-Date: {warc_date(target.fields['date'])}",
        ]
        page = (_http(target.content) or (b"", {}, b""))[1].get("x-page-id")
        lines += [f"X-Refers-To-Page-Id: {page}"] if page else []
    return _record(lines, http[0] if revisits else record.content)


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def convert(arc: bytes, targets: Iterable[ArcRecord | None] | None = None) -> bytes:
    """The WARC file of an ARC file: a gzip member for each record, the warcinfo first. targets: by record, as for to_warc."""
    arc = plain(arc)
    info, first = to_warcinfo(read_version(arc)[0])
    records = list(read_arc(arc))
    targets = [None] * len(records) if targets is None else targets
    return b"".join([_member(first), *(_member(to_warc(r, t, info)) for r, t in zip(records, targets, strict=True))])


def convert_files(files: DataFrame) -> DataFrame:
    """archive (name), data (a WARC file of gzip members) of every ARC file (path, content; as Spark's binaryFile source reads them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = re.sub(r"\.arc(\.gz)?$", "", path.rpartition("/")[2]) + ".warc.gz"
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([convert(content.as_py())], pa.binary())], ["archive", "data"])

    return files.select("path", "content").filter("content is not null").mapInArrow(run, "archive string, data binary")


def read_warc(data: bytes, info: bool = False) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the captures, with info also of the warcinfo records, of a WARC file of gzip members; digests are checked."""
    while data:
        unpacker = zlib.decompressobj(31)
        record = unpacker.decompress(data)
        data = unpacker.unused_data
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = (line.partition(":") for line in head.decode("utf-8", "surrogateescape").split("\r\n")[1:])
        fields = {name: value.strip(" ") for name, _, value in lines}
        block = rest[: int(fields["Content-Length"])]
        if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"damaged block of {fields['WARC-Record-ID']}")
        if info or fields["WARC-Type"] != "warcinfo":
            yield fields, block


def _capture(page: int | None, url: str | None, payload: bytes) -> tuple[str, str, bytes]:
    name = "" if page is None else str(page)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {name}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else f"urn:page:{name}", "text/html", head.encode() + payload


def _captured(page: int | None, url: str | None, payload: bytes) -> ArcRecord:
    """The record of a page's capture as an archive holds it."""
    return next(read_arc(write_arc([_capture(page, url, payload)])))


def _targets(pages: DataFrame, min_bytes: int) -> DataFrame:
    """sha, bytes, target (page_id and url of its response) and n of every payload that several rows share."""
    light = pages.filter(F.col("bytes") >= min_bytes).groupBy("sha", "bytes")
    found = light.agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("target"), F.count("*").alias("n"))
    return _scratch.table(found.filter("n > 1"), "payloads")


def write(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The archives of all pages: archive (name), data (a WARC file of gzip members)."""
    base = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("bytes", F.length("payload")).withColumn("sha", F.unhex(F.sha1("payload")))
    same = _targets(base, min_bytes)
    rows = same.agg(F.sum("n")).first()[0] or 0
    hot = same.filter(F.col("n") * HOT >= rows).select("sha", "bytes", F.col("target").alias("hot"), F.lit(True).alias("is_hot"))
    cold = same.filter(F.col("n") * HOT < rows).select(F.col("sha").alias("key"), F.col("bytes").alias("size"), F.col("target").alias("cold"))
    marked = base.join(F.broadcast(hot), ["sha", "bytes"], "left")
    own = F.unhex(F.sha2(F.concat_ws("/", F.col("page_id").cast("string"), "url"), 256))
    marked = marked.withColumn("key", F.when(F.col("is_hot"), own).otherwise(F.col("sha")))
    joined = marked.join(cold.hint("shuffle_hash"), (marked["key"] == cold["key"]) & (marked["bytes"] == cold["size"]), "left")
    target = F.coalesce("hot", "cold")
    joined = joined.select("page_id", "url", "payload", target["page_id"].alias("target"), target["url"].alias("target_url"))

    def pack(rows: list[tuple]) -> tuple[str, bytes]:
        captures = [_capture(page, url, payload) for page, url, payload, _, _ in rows]
        targets = [None if target is None or target == page else _captured(target, url, payload) for page, _, payload, target, url in rows]
        data = convert(write_arc(captures), targets)
        return f"pages-{hashlib.sha1(data).hexdigest()}.warc.gz", data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple[str, bytes]]:
            rows, size = [], 0
            for batch in batches:
                for values in zip(*(c.to_pylist() for c in batch.columns)):
                    if rows and size + len(values[2]) > ARCHIVE_BYTES:
                        yield pack(rows)
                        rows, size = [], 0
                    rows.append(values)
                    size += len(values[2])
            if rows:
                yield pack(rows)

        for name, data in files():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], ["archive", "data"])

    return joined.mapInArrow(run, "archive string, data binary")


def read(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url of every capture; what a record doesn't tell is null."""

    def number(text: str | None) -> int | None:
        return int(text) if text and re.fullmatch(r"-?\d+", text) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, block in read_warc(data.as_py()):
                    head, http, payload = _http(block) or (b"", {}, block)
                    kind, own = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind != "revisit" and digest(payload) != own:
                        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
                    size = number(http.get("content-length")) if kind == "revisit" else len(payload)
                    rows.append((number(http.get("x-page-id")), size, own, kind, number(fields.get("X-Refers-To-Page-Id")), fields["WARC-Record-ID"], fields["WARC-Target-URI"]))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(types), types)], names)

    return archives.select("data").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string")


def archive(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the archives of all pages in the shared folder and reads them back."""
    return read(_scratch.table(write(pages, min_bytes), "archives", "none"))


def export(archives: DataFrame, folder: str) -> None:
    """Copies archives to files of a folder that executors and driver mount alike."""

    def run(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            path = os.path.join(folder, row["archive"])
            with open(f"{path}.part", "wb") as f:
                f.write(row["data"])
            os.replace(f"{path}.part", path)

    archives.foreachPartition(run)
