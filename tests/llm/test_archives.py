"""ARC to WARC: versions, lengths, digests and a round trip through Spark."""

import base64
import hashlib

import pytest

from lodestrata.llm import archives


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_round_trip(version):
    captures = [("http://a/", "text/html", b"x\n\n1 2 3\n"), ("http://b/", "text/html", b""), ("http://c/", "t", b"\r\n\r\n")]
    records = list(archives.read_arc(archives.write_arc(captures, version)))
    assert [(r.fields["url"], r.fields["type"], r.content) for r in records] == captures
    assert set(records[0].fields) == set(archives.ARC_FIELDS[version])


def test_damaged_arc():
    data = archives.write_arc([("http://a/", "text/html", b"abc")])
    with pytest.raises(ValueError, match="shorter than declared"):
        list(archives.read_arc(data[:-3]))


def test_damaged_warc():
    head = b"HTTP/1.1 200 OK\r\nX-Page-Id: 1\r\nContent-Length: 3\r\n\r\nabc"
    record = archives.to_warc(next(archives.read_arc(archives.write_arc([("u", "t", head)]))), None)
    import gzip

    assert len(list(archives.read_warc(gzip.compress(record)))) == 1
    with pytest.raises(ValueError, match="damaged"):
        list(archives.read_warc(gzip.compress(record.replace(b"abc", b"abd"))))


def want(rows, least=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        top = max(same, default=None) if len([1 for _, _, h in rows if (h or "").encode() == payload]) > 1 and len(payload) >= least else page
        revisit = top is not None and top != page
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 2])
def test_pages(spark, least):
    rows = [(1, "http://a b/é", "x"), (2, None, "x"), (3, "http://c/", None), (4, "u", ""), (4, "u", ""), (None, "http://z", "x"), (9, "http://q", "yé"), (10, "q", "yé"), (11, "big", "<p>" * 2_000_000), (-5, "n", "\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS payload", "1 AS bytes")
    got = archives.archive(df, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(str(tuple(r)) for r in got) == want(rows, least)


def test_empty_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    assert archives.archive(df.limit(0)).count() == 0
    archives.export(archives.write(df), str(tmp_path))
    data = next(tmp_path.glob("*.warc.gz")).read_bytes()
    assert [f["WARC-Type"] for f, _ in archives.read_warc(data)] == ["response"]


VERSION_1 = b"1 0 Example Archive\nURL IP-address Archive-date Content-type Archive-length\n"
VERSION_2 = b"2 0 Example Archive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
HTTP = b"HTTP/1.0 200 OK\r\nDate: Mon, 01 Jan 2001 00:00:00 GMT\r\nserver:x\r\nno colon here\r\n\r\n<html>one</html>"
LF_ONLY = b"HTTP/1.0 404 Not Found\nContent-Type: text/plain\n\ngone\n\nfor good"
DNS = b"20010101000000\nexample.org.\t86400\tIN\tA\t192.0.2.7"


def arc(version, block, records, gzipped=False):
    """Bytes of an ARC file, written here by hand: not by the module's own writer."""
    import gzip

    between = " 200 - - 0 x.arc " if version == 2 else " "
    parts = [b"filedesc://x.arc 192.0.2.1 20010101000000 text/plain" + between.encode() + str(len(block)).encode() + b"\n" + block + b"\n"]
    for line, content in records:
        tail = f"{between}{len(content)}\n" if version == 2 else f" {len(content)}\n"
        parts.append(line.encode() + tail.encode() + content + b"\n")
    return b"".join(gzip.compress(p) for p in parts) if gzipped else b"".join(parts)


RECORDS = [
    ("http://example.org/ 192.0.2.7 20010203040506 text/html", HTTP),
    ("http://example.org/a b c 192.0.2.8 20010203040507 text/html; charset=utf-8", LF_ONLY),
    ("dns:example.org 192.0.2.9 20010203040508 text/dns", DNS),
    ("http://example.org/old - 20010203 text/html", b"<html>no status line</html>"),
    ("http://example.org/cut 2001:db8::1 20010203040509 text/html", b"HTTP/1.1 204 No Content\r\nX: y"),
    ("http://example.org/empty 192.0.2.7 20010203040510 no-type", b""),
]


@pytest.mark.parametrize("gzipped", [False, True])
@pytest.mark.parametrize("version", [1, 2])
def test_genuine_arc(version, gzipped):
    data = arc(version, VERSION_1 if version == 1 else VERSION_2, RECORDS, gzipped)
    (info, facts), *found = list(archives.read_warc(archives.convert(data), info=True))
    assert info["WARC-Type"] == "warcinfo" and info["WARC-Filename"] == "x.arc" and info["WARC-IP-Address"] == "192.0.2.1"
    assert b"publisher: Example Archive" in facts and f"ARC version {version}".encode() in facts
    assert all(f["WARC-Warcinfo-ID"] == info["WARC-Record-ID"] for f, _ in found)
    assert [b for _, b in found] == [c for _, c in RECORDS]
    assert [f["WARC-Type"] for f, _ in found] == ["response", "response", "resource", "resource", "response", "resource"]
    assert [f["WARC-Target-URI"] for f, _ in found[:3]] == ["http://example.org/", "http://example.org/a%20b%20c", "dns:example.org"]
    assert [f.get("WARC-IP-Address") for f, _ in found] == ["192.0.2.7", "192.0.2.8", "192.0.2.9", None, "2001:db8::1", "192.0.2.7"]
    assert [f["WARC-Date"] for f, _ in found[:4]] == ["2001-02-03T04:05:06Z", "2001-02-03T04:05:07Z", "2001-02-03T04:05:08Z", "2001-02-03T00:00:00Z"]
    assert [f["Content-Type"] for f, _ in found[2:4]] == ["text/dns", "text/html"]
    payloads = [b"<html>one</html>", b"gone\n\nfor good", DNS, RECORDS[3][1], b"", b""]
    assert [f["WARC-Payload-Digest"] for f, _ in found] == [f"sha1:{base64.b32encode(hashlib.sha1(p).digest()).decode()}" for p in payloads]
    assert len({f["WARC-Record-ID"] for f, _ in found}) == len(RECORDS)


def test_declared_fields_count():
    """A version block may declare other fields than its version's."""
    block = b"1 1 Other\nURL IP-address Archive-date Content-type Checksum Archive-length\n"
    data = b"filedesc://x 0.0.0.0 20010101000000 text/plain " + str(len(block)).encode() + b"\n" + block + b"\nhttp://a/ 1.2.3.4 20010101000000 text/plain abcd 3\nxyz\n"
    (record,) = archives.read_arc(data)
    assert record.fields["checksum"] == "abcd" and record.content == b"xyz"


@pytest.mark.parametrize(
    "data, says",
    [
        (b"no arc at all\n", "no version block"),
        (b"filedesc://x 0.0.0.0 20010101000000 text/plain ten\n", "no length"),
        (b"filedesc://x 0.0.0.0 20010101000000 text/plain 3\n9 0", "is shorter|none of"),
        (arc(1, VERSION_1, []) + b"http://a/ 1.2.3.4 yesterday text/html 3\nabc\n", "no date and length"),
        (arc(1, VERSION_1, []) + b"http://a/ 1.2.3.4 20010101000000 text/html 30\nabc\n", "shorter than declared"),
    ],
)
def test_bad_arc(data, says):
    with pytest.raises(ValueError, match=says):
        list(archives.read_arc(data))


def test_revisit_of_a_plain_record():
    first, second = list(archives.read_arc(arc(1, VERSION_1, [RECORDS[0], ("http://b.example/ 192.0.2.7 20020203040506 text/html", HTTP)])))
    fields, block = next(archives.read_warc(archives._member(archives.to_warc(second, first))))
    assert fields["WARC-Type"] == "revisit" and fields["WARC-Refers-To"] == archives.record_id(first) and block == HTTP[: -len(b"<html>one</html>")]
    assert fields["WARC-Refers-To-Target-URI"] == "http://example.org/" and fields["WARC-Refers-To-Date"] == "2001-02-03T04:05:06Z"


def test_arc_files_of_a_folder(spark, tmp_path):
    (tmp_path / "one.arc").write_bytes(arc(1, VERSION_1, RECORDS))
    (tmp_path / "two.arc.gz").write_bytes(arc(2, VERSION_2, RECORDS, True))
    done = archives.convert_files(spark.read.format("binaryFile").load(str(tmp_path)))
    assert sorted(r["archive"] for r in done.collect()) == ["one.warc.gz", "two.warc.gz"]
    rows = archives.read(done).collect()
    assert sorted(r["payload_bytes"] for r in rows) == sorted([16, 14, len(DNS), len(RECORDS[3][1]), 0, 0] * 2)


def test_hot_payload(spark):
    """A payload that most rows share and many that few share."""
    rows = [(i, f"http://h/{i}", "same" if i % 3 else f"pair {i % 200}") for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = archives.archive(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(str(tuple(r)) for r in got) == want(rows)
