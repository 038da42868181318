import gzip
import hashlib
import json
import os
import zipfile

import pytest

from postlens.llm import warc_zip
from postlens.llm.warc_zip import archive_pages, central_directory, indexed_records, member_start, parse_record, payload_records, read_records, record_bytes, row_id, write_archives

PAGES = "page_id long, url string, html string"


def reader(path):
    file = open(path, "rb")

    def read(start, length):
        file.seek(start)
        return file.read(length)

    return read, os.path.getsize(path), file


def expected(pages, least=100):
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        same = [j for j, _, other in pages if (other or "").encode() == payload and j is not None]
        first = min(same) if len(payload) >= least and same else i
        kind = "response" if i == first else "revisit"
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), kind, None if i == first else first))
    return sorted(out, key=str)


def found(records):
    rows = records.select(row_id(records.record_id).cast("long").alias("i"), "payload_bytes", "digest", "record_type", row_id(records.refers_to).cast("long").alias("r"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_round_trip(spark):
    body = "<p>" + "é😀" * 40 + "</p>\r\n\r\nmore"
    pages = [(5, "http://a/1", body), (2, "http://a/2\r\nX: y", body), (9, None, body), (1, "http://a/4", "short"), (3, "u", "short")]
    pages += [(4, "u", None), (6, "u", ""), (None, "u", body), (7, "u", "x" * 100), (8, "u", "x" * 100), (10, "u", "x" * 99), (11, "u", "x" * 99)]
    pages += [(12, "u", "y" * 200), (12, "u", "y" * 200), (13, "long", "z\n" * 1_500_000), (None, "n", "n" * 200), (None, "n", "n" * 200)]
    frame = spark.createDataFrame(pages, PAGES).selectExpr("*", "'mine' AS digest", "7 AS record_id").repartition(3)
    archives = archive_pages(frame)
    records = read_records(archives)
    assert found(records) == expected(pages)
    assert archives.agg({"records": "sum"}).first()[0] == len(pages)
    payloads = {(row.record_id, row.record_type): row.payload for row in records.collect()}
    assert payloads["urn:page_id:2", "response"] == body.encode() and payloads["urn:page_id:5", "revisit"] is None
    assert payloads["urn:page_id:13", "response"] == b"z\n" * 1_500_000 and payloads["urn:page_id:4", "response"] == b""


def test_empty_table(spark):
    archives = archive_pages(spark.createDataFrame([], PAGES))
    assert archives.collect() == [] and read_records(archives).collect() == []


def test_members_and_archives_roll(spark, tmp_path):
    pages = [(k, f"http://h/{k % 7}", os.urandom(300).hex()) for k in range(60)]
    records = payload_records(spark.createDataFrame(pages, PAGES).coalesce(1))
    archives = write_archives(records, f"file://{tmp_path}/out", member_bytes=2000, archive_bytes=9000, archive_records=15)
    files = [r.archive.removeprefix("file://") for r in archives.collect()]
    assert len(files) >= 4 and found(read_records(archives, range_bytes=700)) == expected(pages)
    for name in files:
        with zipfile.ZipFile(name) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            assert len([n for n in z.namelist() if n.startswith("archive/")]) > 1
            lines = z.read("indexes/index.cdxj").decode().splitlines()
            assert lines == sorted(lines)
            entry = json.loads(lines[0].split(" ", 2)[2])
            data = z.read(entry["filename"])[entry["offset"] : entry["offset"] + entry["length"]]
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")


def members(path):
    read, size, file = reader(path)
    with file:
        return {m.name: (m.size, member_start(read, m) if m.method == 0 else None) for m in central_directory(read, size)}


def test_directories_against_zipfile(tmp_path, monkeypatch):
    plain = tmp_path / "plain.zip"
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("archive/é.warc", b"x" * 10)
        z.writestr("b", b"y" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 a comment with an end record's mark"
    before = tmp_path / "before.zip"
    before.write_bytes(b"#!/bin/sh\n" * 50 + plain.read_bytes())
    for path, shift in ((plain, 0), (before, 500)):
        got = members(path)
        assert got["b"] == (1000, None) and got["archive/é.warc"][0] == 10
        start = got["archive/é.warc"][1]
        assert path.read_bytes()[start : start + 10] == b"x" * 10 and start > shift
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)  # makes ZIP64 end records
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 900)  # makes ZIP64 fields
    wide = tmp_path / "wide.zip"
    with zipfile.ZipFile(wide, "w") as z:
        for k in range(6):
            z.writestr(f"m{k}", bytes([k]) * 1000)
    monkeypatch.setattr(warc_zip, "BLOCK", 60)  # entries across blocks
    got, data = members(wide), wide.read_bytes()
    assert b"PK\x06\x06" in data and [data[got[f"m{k}"][1]] for k in range(6)] == list(range(6))
    moved = tmp_path / "moved.zip"
    moved.write_bytes(b"~" * 333 + data)
    assert members(moved)["m5"] == (1000, got["m5"][1] + 333)


def test_offsets_beyond_4_gb(tmp_path):
    path = tmp_path / "sparse.zip"
    with open(path, "wb") as f:
        f.truncate((1 << 32) + 5000)  # no disk is used for the gap
    with zipfile.ZipFile(path, "a") as z:
        z.writestr("archive/far.warc", b"far away")
    read, size, file = reader(path)
    with file:
        (member,) = central_directory(read, size)
        assert member.header > 1 << 32 and read(member_start(read, member), 8) == b"far away"


def test_what_cannot_be_read_is_an_error(spark, tmp_path):
    record = record_bytes("urn:x:1", "u", b"p" * 200, hashlib.sha256(b"p" * 200).hexdigest(), None)
    assert parse_record(record).payload == b"p" * 200 and parse_record(gzip.decompress(record)).uri == "u"
    with pytest.raises(ValueError):
        parse_record(record_bytes("urn:x:1", "u", b"p" * 200, hashlib.sha256(b"q").hexdigest(), None))
    with pytest.raises(ValueError):
        parse_record(b"no record")
    (tmp_path / "junk").write_bytes(b"PK\x05\x06 junk" * 9)
    with pytest.raises(ValueError):
        members(tmp_path / "junk")
    packed = tmp_path / "packed.zip"
    for name, kind in (("archive/a.warc.gz", zipfile.ZIP_DEFLATED), ("archive/a.warc.gz", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(packed, "w", kind) as z:
            z.writestr(name, record * 50)
        with pytest.raises(Exception, match="compressed|no index"):
            indexed_records(spark.createDataFrame([(f"file://{packed}",)], "archive string")).collect()


def test_foreign_archive_with_packed_index(spark, tmp_path):
    """Names without a folder, a gzip index, an uncompressed member."""
    record = gzip.decompress(record_bytes("urn:x:1", "u", b"p" * 200, hashlib.sha256(b"p" * 200).hexdigest(), None))
    line = f'com,x)/ 2020 {json.dumps({"filename": "a.warc", "offset": str(len(record)), "length": str(len(record))})}\n'
    path = tmp_path / "foreign.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("archive/a.warc", record * 2)
        z.writestr("indexes/index.cdx.gz", gzip.compress(line.encode()) + gzip.compress(b""))
        z.writestr("pages/pages.jsonl", "{}", zipfile.ZIP_DEFLATED)
    (row,) = read_records(spark.createDataFrame([(f"file://{path}",)], "archive string")).collect()
    assert (row.record_id, row.payload_bytes, row.payload) == ("urn:x:1", 200, b"p" * 200)
