"""WARC records in ZIP-packaged archives, written and read by ranges.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``, the records as one gzip member each, and
``indexes/index.cdxj``, a line per record with its place in the former. The reader parses the end record,
the ZIP64 locator and record where they are, and the central directory; reads the index; then reads runs of
records by range and unpacks them one by one. No member is ever extracted whole.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes, that with the largest page id is a response and
the others are revisits that refer to it and carry no payload. Equal payloads are found by digest, counted
before any shuffle of pages, and only digests that occur more than once are joined to the pages; the
adaptive join splits one that holds a large share.

Defined cases: a null payload is empty; pages with equal payloads whose ids are all null are responses, as are all rows of
the largest id; a null id is kept as null; a null url becomes an empty target; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import storage
from tallyloom.llm.stages import stored
from tallyloom.scratch import new_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 4 << 20
DATE = "2025-01-01T00:00:00Z"
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Signatures and layouts of the ZIP format, and where a field refers to its 64-bit form.
LOCAL, DESCRIPTOR, CENTRAL = b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_HEAD = struct.Struct("<4s5H3I2H")
CENTRAL_HEAD = struct.Struct("<4s6H3I5H2I")
END_HEAD = struct.Struct("<4s4H2IH")
END64_HEAD = struct.Struct("<4sQ2H2I4Q")
LOCATOR64_HEAD = struct.Struct("<4sIQI")
BIG32, BIG16 = 0xFFFFFFFF, 0xFFFF


class Member(NamedTuple):
    name: str
    offset: int  # of the local header
    size: int
    method: int


class ZipWriter:
    """Stored members written front to back; sizes follow each member in a descriptor."""

    def __init__(self, stream, always64: bool = False):
        self.stream, self.at, self.members, self.always64 = stream, 0, [], always64

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.offset, self.crc, self.size = name.encode(), self.at, 0, 0
        # Version 4.5, sizes in a descriptor, stored, 1980-01-01. The ZIP64 field makes the descriptor 64-bit.
        extra = struct.pack("<2H2Q", 1, 16, 0, 0)
        self.write(LOCAL_HEAD.pack(LOCAL, 45, 8 | 1 << 11, 0, 0, 33, 0, BIG32, BIG32, len(self.name), len(extra)) + self.name + extra)

    def data(self, part: bytes) -> None:
        self.crc = zlib.crc32(part, self.crc)
        self.size += len(part)
        self.write(part)

    def end(self) -> None:
        self.write(struct.pack("<4sI2Q", DESCRIPTOR, self.crc, self.size, self.size))
        self.members.append((self.name, self.offset, self.size, self.crc))

    def close(self) -> None:
        start = self.at
        for name, offset, size, crc in self.members:
            wide = self.always64 or max(size, offset) >= BIG32
            extra = struct.pack("<2H3Q", 1, 24, size, size, offset) if wide else b""
            shown = (BIG32, BIG32) if wide else (size, size)
            self.write(CENTRAL_HEAD.pack(CENTRAL, 45, 45, 8 | 1 << 11, 0, 0, 33, crc, *shown, len(name), len(extra), 0, 0, 0, 0, BIG32 if wide else offset) + name + extra)
        size, n = self.at - start, len(self.members)
        wide = self.always64 or n >= BIG16 or max(size, start) >= BIG32
        if wide:
            at = self.at
            self.write(END64_HEAD.pack(END64, 44, 45, 45, 0, 0, n, n, size, start))
            self.write(LOCATOR64_HEAD.pack(LOCATOR64, 0, at, 1))
        counts, places = ((BIG16, BIG16), (BIG32, BIG32)) if wide else ((n, n), (size, start))
        self.write(END_HEAD.pack(END, 0, 0, *counts, *places, 0))
        self.stream.close()


def members(handle) -> dict[str, Member]:
    """The members of an archive from its directories, read by ranges."""
    size = handle.size()
    tail_at = max(0, size - END_HEAD.size - BIG16)
    tail = storage.read_range(handle, tail_at, size - tail_at)
    at = len(tail) - END_HEAD.size
    while at >= 0:
        at = tail.rfind(END, 0, at + 4)
        if at < 0:
            raise ValueError("no end of central directory")
        if at + END_HEAD.size <= len(tail) and at + END_HEAD.size + END_HEAD.unpack_from(tail, at)[-1] == len(tail):
            break
        at -= 1
    *_, n, length, start, _ = END_HEAD.unpack_from(tail, at)
    locator = tail_at + at - LOCATOR64_HEAD.size
    if (n == BIG16 or BIG32 in (length, start)) and locator >= 0:
        mark, _, place, _ = LOCATOR64_HEAD.unpack(storage.read_range(handle, locator, LOCATOR64_HEAD.size))
        if mark == LOCATOR64:
            *_, n, length, start = END64_HEAD.unpack(storage.read_range(handle, place, END64_HEAD.size))
    directory, found, at = storage.read_range(handle, start, length), {}, 0
    for _ in range(n):
        head = CENTRAL_HEAD.unpack_from(directory, at)
        if head[0] != CENTRAL:
            raise ValueError("not a central directory entry")
        method, packed, plain, names, extras, notes, offset = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
        at += CENTRAL_HEAD.size
        name = directory[at : at + names].decode()
        extra = directory[at + names : at + names + extras]
        at += names + extras + notes
        found[name] = Member(name, *_wide(extra, plain, packed, offset), method)
    return found


def _wide(extra: bytes, plain: int, packed: int, offset: int) -> tuple[int, int]:
    """Offset and size, from the ZIP64 field for those that refer to it."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            plain = next(values) if plain == BIG32 else plain
            packed = next(values) if packed == BIG32 else packed
            offset = next(values) if offset == BIG32 else offset
        at += 4 + length
    return offset, packed


def data_offset(handle, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method:
        raise ValueError(f"{member.name} is not stored")
    head = LOCAL_HEAD.unpack(storage.read_range(handle, member.offset, LOCAL_HEAD.size))
    if head[0] != LOCAL:
        raise ValueError("not a local header")
    return member.offset + LOCAL_HEAD.size + head[-2] + head[-1]


def record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(identifier: str) -> int | None:
    value = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record(page_id, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, with the payload's length, and drops the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
        "WARC-Target-URI: " + quote(url or "", safe=":/?#[]@!$&'()*+,;=%~"), "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}


def parse_record(raw: bytes) -> Record:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = _fields(lines)
    block = rest[: int(headers["content-length"])]
    if len(block) != int(headers["content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return Record(headers, _fields(http.split(b"\r\n")[1:]), payload)


def with_revisits(pages: DataFrame, *, page_id="page_id", url="url", html="html") -> DataFrame:
    """``page_id, url, payload, first``: where ``first`` is set, the page revisits it."""
    payload = F.coalesce(F.col(html), F.lit(""))
    named = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"))
    large = named.where(F.octet_length("payload") >= REVISIT_BYTES)
    repeated = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).where("n > 1").select("digest", "first")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return named.join(repeated, "digest", "left").select("page_id", "url", "payload", other.alias("first"))


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, always64: bool = False) -> DataFrame:
    """Writes the records of :func:`with_revisits`; the table of archives, ``path, n_records``."""
    folder = new_path(records.sparkSession, "archives")

    def run(batches):
        held = None

        def close():
            writer, index, uri = held
            writer.end()
            writer.begin(INDEX)
            writer.data("".join(index).encode())
            writer.end()
            writer.close()
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(index)])], names=["path", "n_records"])

        for batch in batches:
            ids, urls, firsts = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i, payload in enumerate(batch.column(2)):
                if held is None:
                    uri, stream = storage.new_file(folder, "pages", ".wacz")
                    held = ZipWriter(stream, always64), [], uri
                    held[0].begin(RECORDS)
                writer, index, _ = held
                packed = gzip.compress(record(ids[i], urls[i], payload.as_buffer().to_pybytes(), firsts[i]), 3, mtime=0)
                place = {"url": urls[i] or "", "offset": writer.size, "length": len(packed), "filename": RECORDS}
                index.append(f"{record_id(ids[i])} {DATE} {json.dumps(place)}\n")
                writer.data(packed)
                if writer.size >= archive_bytes:
                    yield close()
                    held = None
        if held is not None:
            yield close()

    return stored(records.mapInArrow(run, "path string, n_records bigint"), "archives")


def records_of(uri: str, read_bytes: int = READ_BYTES):
    """Every record of an archive, from range reads of neighbouring records."""
    with storage.random_access(uri) as handle:
        found = members(handle)
        index = storage.read_range(handle, data_offset(handle, found[INDEX]), found[INDEX].size).decode()
        base = data_offset(handle, found[RECORDS])
        places = [json.loads(line.split(" ", 2)[2]) for line in index.splitlines()]
        first = 0
        while first < len(places):
            start, last = places[first]["offset"], first
            while last + 1 < len(places) and places[last + 1]["offset"] + places[last + 1]["length"] - start <= read_bytes:
                last += 1
            raw = storage.read_range(handle, base + start, places[last]["offset"] + places[last]["length"] - start)
            for place in places[first : last + 1]:
                at = place["offset"] - start
                yield parse_record(gzip.decompress(raw[at : at + place["length"]]))
            first = last + 1


READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record; a response's digest is computed from its payload and must match its header."""

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                for r in records_of(uri):
                    digest = base64.b32decode(r.headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    revisit = r.headers["warc-type"] == "revisit"
                    if not revisit and hashlib.sha1(r.payload).hexdigest() != digest:
                        raise ValueError(f"{uri}: a payload does not match its digest")
                    refers = page_of(r.headers["warc-refers-to"]) if revisit else None
                    rows.append((page_of(r.headers["warc-record-id"]), r.headers["warc-target-uri"], int(r.http["content-length"]), digest, r.headers["warc-type"], refers))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=READ.replace(",", "").split()[::2])

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(parts, "path").mapInArrow(run, READ)
