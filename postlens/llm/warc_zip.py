"""WARC records in ZIP-packaged archives: written by tasks, read back by byte ranges without extraction.

An archive is a ZIP file of stored (not compressed) members: `archive/data-<n>.warc.gz`, in which every WARC record is
a gzip member of its own, and `indexes/index.cdxj`, which names the member, offset and length of each record. Tasks
write archives below the shared folder and roll to the next one by size. File names are unique to a task attempt and
only those in the written manifest are read, so a lost or repeated task does no harm.

Reading: a task finds an archive's end record at its tail, follows the ZIP64 locator where there is one, walks the
central directory in blocks, finds each stored member's first byte through its local header, and streams the index.
The index rows are grouped by byte ranges of the archives, so ranges of any archive are dealt over all tasks; each
range is read at once and its records are cut out, unpacked and checked against their digests.

Records with equal payloads: the first is a response, others are revisits that refer to it and hold no payload. Which
is first is decided on narrow rows with partial sums; payloads are shuffled only to meet the list of revisits, and not
even then where that list is small enough for Spark to broadcast by its written size.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.frames import slices, utf8
from postlens.session import fresh_path, materialise

LEAST_REVISIT = 100
MEMBER_BYTES, ARCHIVE_BYTES, ARCHIVE_RECORDS = 16 << 20, 64 << 20, 50_000
RANGE_BYTES, BLOCK = 4 << 20, 1 << 20
DATE = "2020-01-01T00:00:00Z"
INDEX = "indexes/index.cdxj"
# Fixed values of the WARC and ZIP formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END, _LOCATOR, _END64, _CENTRAL, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_FULL2, _FULL4 = 0xFFFF, 0xFFFFFFFF
_STORED, _ENCRYPTED, _UTF8 = 0, 0x1, 0x800

Read = Callable[[int, int], bytes]


class Member(NamedTuple):
    """A member of an archive, as its central directory has it."""

    name: str
    method: int
    packed: int
    size: int
    header: int


def central_directory(read: Read, size: int) -> Iterator[Member]:
    """The members of a ZIP file of `size` bytes; `read(start, length)` gives a range of it. Data before the archive is allowed."""
    tail_at = max(0, size - 22 - _FULL2)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP archive")
    disk, first_disk, _, entries, length, start = struct.unpack_from("<4H2I", tail, at + 4)
    end = tail_at + at
    locator = read(end - 20, 20) if end >= 20 else b""
    if locator[:4] == _LOCATOR:
        record_at = struct.unpack_from("<Q", locator, 8)[0]
        record = read(record_at, 56)
        if record[:4] != _END64:  # data before the archive: the record then lies right before its locator
            record_at = end - 20 - 56
            record = read(record_at, 56)
        if record[:4] != _END64:
            raise ValueError("the ZIP64 end record is not where its locator points")
        disk, first_disk, _, entries, length, start = struct.unpack_from("<2I4Q", record, 16)
        end = record_at
    elif _FULL2 in (disk, first_disk) or _FULL4 in (length, start):
        raise ValueError("no ZIP64 locator, though the end record asks for one")
    if disk or first_disk:
        raise ValueError("archives of several disks are not read")
    shift = end - length - start
    if shift < 0:
        raise ValueError("the central directory overlaps the end record")
    yield from _entries(read, start + shift, length, entries, shift)


def _entries(read: Read, start: int, length: int, entries: int, shift: int) -> Iterator[Member]:
    """Walk the directory in blocks of bounded size."""
    buffer, at, fetched = b"", 0, 0

    def need(n: int) -> None:
        nonlocal buffer, at, fetched
        while len(buffer) - at < n:
            if fetched >= length:
                raise ValueError("the central directory ends within an entry")
            block = read(start + fetched, min(BLOCK, length - fetched))
            if not block:
                raise ValueError("the archive ends within its central directory")
            buffer, at, fetched = buffer[at:] + block, 0, fetched + len(block)

    for _ in range(entries):
        need(46)
        if buffer[at : at + 4] != _CENTRAL:
            raise ValueError("no entry where the central directory should have one")
        flags, method = struct.unpack_from("<2H", buffer, at + 8)
        packed, size, names, extras, comments = struct.unpack_from("<2I3H", buffer, at + 20)
        header = struct.unpack_from("<I", buffer, at + 42)[0]
        need(46 + names + extras + comments)
        name = buffer[at + 46 : at + 46 + names].decode("utf-8" if flags & _UTF8 else "cp437")
        extra = buffer[at + 46 + names : at + 46 + names + extras]
        at += 46 + names + extras + comments
        if flags & _ENCRYPTED:
            raise ValueError(f"member {name} is encrypted")
        size, packed, header = _wide(extra, (size, packed, header))
        yield Member(name, method, packed, size, header + shift)


def _wide(extra: bytes, fields: tuple[int, int, int]) -> tuple[int, ...]:
    """Sizes and offset with those that a ZIP64 field holds in 64 bits in place of their filled 32 bits."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 0x0001:
            wide = extra[at + 4 : at + 4 + length]
        at += 4 + length
    out, at = [], 0
    for value in fields:
        if value == _FULL4 and at + 8 <= len(wide):
            value = struct.unpack_from("<Q", wide, at)[0]
            at += 8
        out.append(value)
    return tuple(out)


def member_start(read: Read, member: Member) -> int:
    """Position of a stored member's first byte, from its local header (whose fields may differ in length from the directory's)."""
    if member.method != _STORED:
        raise ValueError(f"member {member.name} is compressed: its records cannot be read by range")
    header = read(member.header, 30)
    if header[:4] != _LOCAL:
        raise ValueError(f"no local header of member {member.name}")
    names, extras = struct.unpack_from("<2H", header, 26)
    return member.header + 30 + names + extras


def _lines(read: Read, start: int, size: int, packed: bool) -> Iterator[bytes]:
    """Lines of a member, fetched in blocks; a gzip one is unpacked on the way (all of its gzip members)."""
    left, unpack = b"", zlib.decompressobj(31) if packed else None
    for at in range(start, start + size, BLOCK):
        block = read(at, min(BLOCK, start + size - at))
        while block and unpack is not None:
            left += unpack.decompress(block)
            block = unpack.unused_data if unpack.eof else b""
            unpack = zlib.decompressobj(31) if unpack.eof else unpack
        *lines, left = (left + block).split(b"\n")
        yield from lines
    if left:
        yield left


def _open(uri: str) -> tuple[Read, int, object]:
    system, path = pafs.FileSystem.from_uri(uri)
    file = system.open_input_file(path)

    def read(start: int, length: int) -> bytes:
        file.seek(start)
        return file.read(length)

    return read, file.size(), file


def _clean(value: str | None) -> str:
    """A header value without characters that end its line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), value or "")


def record_bytes(record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """A WARC record, as a gzip member; a revisit keeps the HTTP head with the payload's length, not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(uri)}",
        *([f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"] if refers_to else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 1, mtime=0)


class Record(NamedTuple):
    """A WARC record as read back; `payload` is None for a revisit, `payload_bytes` and `digest` are of the full payload."""

    record_id: str
    record_type: str
    uri: str
    refers_to: str | None
    digest: str
    payload_bytes: int
    payload: bytes | None


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, continuation lines joined."""
    lines = re.sub(rb"\r?\n[ \t]+", b" ", head).decode("utf-8", "replace").splitlines()[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(packed: bytes) -> Record:
    """A record from its bytes (a gzip member or plain); a payload that does not have its digest is an error."""
    whole = gzip.decompress(packed) if packed[:2] == b"\x1f\x8b" else packed
    head, found, rest = whole.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("no WARC record at the indexed offset")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    name = lambda value: value.strip("<>") if value else None
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha256:").lower()
    size = int(_fields(http).get("content-length", len(payload)))
    if kind == "revisit":
        payload = None
    elif len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields.get('warc-record-id')} is not the one that was written")
    return Record(name(fields["warc-record-id"]), kind, fields.get("warc-target-uri", ""), name(fields.get("warc-refers-to")), digest, size, payload)


class _Archive:
    """One ZIP file in the making: stored members that roll by size, and the index at its end."""

    def __init__(self, folder: str, member_bytes: int):
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"records-{uuid.uuid4().hex}.zip"
        self.uri, self.member_bytes = f"{folder}/{name}", member_bytes
        self.stream = system.open_output_stream(f"{root}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.name, self.at, self.members, self.bytes = None, "", 0, 0, 0
        self.index: list[str] = []

    def add(self, uri: str | None, digest: str, record: bytes) -> None:
        if self.member is None or self.at >= self.member_bytes:
            if self.member is not None:
                self.member.close()
            self.name, self.at = f"archive/data-{self.members:05d}.warc.gz", 0
            self.member = self.zip.open(self.name, "w", force_zip64=True)
            self.members += 1
        self.member.write(record)
        entry = {"url": uri or "", "digest": f"sha256:{digest}", "filename": self.name, "offset": self.at, "length": len(record)}
        self.index.append(f"{_clean(uri)} {re.sub('[^0-9]', '', DATE)} {json.dumps(entry)}\n")
        self.at += len(record)
        self.bytes += len(record)

    def close(self) -> tuple[str, int, int]:
        if self.member is not None:
            self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for line in sorted(self.index):
                index.write(line.encode())
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.index), self.bytes


def record_name(id_col: str, value: Column) -> Column:
    """The record id of a row: its id, quoted, behind the column's name; NULL gives nothing behind it."""
    return F.concat(F.lit(f"urn:{quote(id_col, safe='')}:"), F.coalesce(F.url_encode(value.cast("string")), F.lit("")))


def row_id(record_id: Column) -> Column:
    """The id, as text, out of a record id; NULL where the row had none."""
    return F.nullif(F.url_decode(F.regexp_extract(record_id, "^urn:[^:]*:(.*)$", 1)), F.lit(""))


def payload_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(record_id, uri, payload, digest, refers_to): what is to be written for each row.

    NULL payloads count as empty. Of rows with equal payloads of at least `least` bytes those with the smallest id are
    responses (repeated rows all are, as none is smaller than the others) and the rest refer to it; ids that are NULL
    count as largest, and where all are NULL each row is a response.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").cast("string").alias("uri"),
        F.coalesce(utf8(F.col(f"`{html_col}`")), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    keys = materialise(rows.filter(F.octet_length("payload") >= least).select("id", F.unhex("digest").alias("key")), "warc-keys")
    equal = keys.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL")
    equal = materialise(equal.select("key", "first"), "warc-equal")  # the join is then dealt on its own, so hot keys can be split
    later = keys.join(equal, "key").filter("id IS NULL OR id <> first").select(F.col("id").alias("of"), "key", "first").distinct()
    later = materialise(later, "warc-revisits")
    joined = rows.join(later, rows["id"].eqNullSafe(later["of"]) & (F.unhex(rows["digest"]) == later["key"]), "left")
    refers = F.when(F.col("first").isNotNull(), record_name(id_col, F.col("first")))
    return joined.select(record_name(id_col, F.col("id")).alias("record_id"), "uri", "payload", "digest", refers.alias("refers_to"))


def write_archives(
    records: DataFrame, folder: str, member_bytes: int = MEMBER_BYTES, archive_bytes: int = ARCHIVE_BYTES, archive_records: int = ARCHIVE_RECORDS
) -> DataFrame:
    """Write records (as `payload_records` gives them) below `folder`; returns (archive, records, bytes) of what was written.

    The number of archives follows the partitions of `records`; an empty partition writes none.
    """

    def write(batches):
        archive, done = None, []
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                if archive is not None and (archive.bytes >= archive_bytes or len(archive.index) >= archive_records):
                    done.append(archive.close())
                    archive = None
                archive = archive or _Archive(folder, member_bytes)
                archive.add(row["uri"], row["digest"], record_bytes(row["record_id"], row["uri"], row["payload"], row["digest"], row["refers_to"]))
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("archive", "records", "bytes"), d)) for d in done],
            schema=pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return materialise(records.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


def indexed_records(archives: DataFrame) -> DataFrame:
    """(archive, start, length): the place of each indexed record in the archives (a column of their URIs)."""

    def locate(batches):
        for batch in batches:
            for uri in batch["archive"].to_pylist():
                read, size, file = _open(uri)
                with file:
                    members = {m.name: m for m in central_directory(read, size)}
                    starts = {name: member_start(read, m) for name, m in members.items() if re.match(r"archive/.*\.warc(\.gz)?$", name)}
                    indexes = [m for name, m in members.items() if re.match(r"indexes/.*\.cdxj?(\.gz)?$", name)]
                    if starts and not indexes:
                        raise ValueError(f"{uri} holds records but no index")
                    at, lengths = [], []
                    for index in indexes:
                        for line in _lines(read, member_start(read, index), index.size, index.name.endswith(".gz")):
                            entry = json.loads(line[line.index(b"{") :])
                            name = entry["filename"] if "/" in entry["filename"] else f"archive/{entry['filename']}"
                            at.append(starts[name] + int(entry["offset"]))
                            lengths.append(int(entry["length"]))
                            if len(at) == 10_000:
                                yield _places(uri, at, lengths)
                                at, lengths = [], []
                    yield _places(uri, at, lengths)

    return archives.select("archive").mapInArrow(locate, "archive string, start long, length long")


def _places(uri: str, at: list[int], lengths: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"archive": pa.array([uri] * len(at), pa.string()), "start": pa.array(at, pa.int64()), "length": pa.array(lengths, pa.int64())})


def read_records(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the archives, one row each: the fields of `Record` (`payload` only if `payloads`).

    The records that begin within `range_bytes` of an archive are one row of a grouping and are read at once.
    """
    names = [n for n in Record._fields if payloads or n != "payload"]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that narrow rows are not coalesced
    ranges = (
        indexed_records(archives)
        .withColumn("range", F.floor(F.col("start") / range_bytes))
        .repartition(tasks, "archive", "range")
        .groupBy("archive", "range")
        .agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("places"))
    )

    def fetch(batches):
        for batch in batches:
            for uri, places in zip(batch["archive"].to_pylist(), batch["places"].to_pylist()):
                read, _, file = _open(uri)
                with file:
                    low = places[0]["start"]
                    data = memoryview(read(low, max(p["start"] + p["length"] for p in places) - low))
                rows, held = [], 0
                for place in places:
                    at = place["start"] - low
                    record = parse_record(bytes(data[at : at + place["length"]]))
                    rows.append({n: getattr(record, n) for n in names})
                    held += record.payload_bytes
                    if held >= range_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names)
    return ranges.select("archive", "places").mapInArrow(fetch, ddl)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write a WARC record for each row of `pages` into archives and return those archives (archive, records, bytes).

    Their folder is one of its own below the shared folder unless given. An empty table writes none; very long payloads
    are records like others; columns besides the three named are ignored.
    """
    records = payload_records(pages, id_col, url_col, html_col)
    return write_archives(records, folder or fresh_path(pages.sparkSession, "warc"))
