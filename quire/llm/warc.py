"""WARC in Zstandard: archives with a leading dictionary frame and one frame per record, written and read on executors.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary; a warcinfo record and one record
per row follow, each in a frame of its own. Files are opened through pyarrow's file systems, so any store that all
executors share will do; they are read in pieces of READ_BYTES and decoded frame by frame, so memory is bounded by the
largest record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hinted, map_arrow, shared_dir

#: Fixed values of the formats.
SKIPPABLE_DICTIONARY = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed beyond so many compressed bytes; its dictionary is trained on its first records, up to these bounds.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 20, 16 << 10, 200, 1 << 20
READ_BYTES = 1 << 16
#: Compressed bytes that are decoded at a time: the format can make 128 KB of four of them, so 32 MB of these at most.
FEED_BYTES = 1 << 10
#: A record that decodes to more is refused, whatever its frame claims; a payload that Spark can hold, with its headers, is less.
RECORD_BYTES = (1 << 31) + (1 << 20)
#: Groups of equal payloads that are broadcast at most; beyond, the join shuffles.
BROADCAST_GROUPS = 500_000
#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 0


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


class BadArchive(ValueError):
    """An archive, a frame, a header or a length that is not as it must be."""


def digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"WARC/1.1\r\n" + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def decode(data: bytes) -> Record:
    """Check and split one record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, fields = head.partition(b"\r\n")
    if not gap or version not in VERSIONS:
        raise BadArchive("no WARC header")
    headers: dict[str, str] = {}
    for line in fields.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise BadArchive(f"bad header line {line[:80]!r}")
        if name.lower() in headers:
            raise BadArchive(f"{name} is given twice")
        headers[name.lower()] = value.strip()
    if missing := [x for x in REQUIRED if x not in headers]:
        raise BadArchive(f"no {', '.join(missing)}")
    if not re.fullmatch(r"\d+", headers["content-length"]):
        raise BadArchive("bad Content-Length")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise BadArchive(f"block of {len(rest) - 4} bytes; Content-Length says {n}")
    return Record(headers, rest[:n])


def payload(record: Record) -> bytes:
    """What follows the HTTP header of a response; the block of others."""
    if record.headers.get("content-type", "").startswith("application/http"):
        head, gap, body = record.block.partition(b"\r\n\r\n")
        if not gap or not head.startswith(b"HTTP/"):
            raise BadArchive("no HTTP header")
        return body
    return record.block


def train(samples: list[bytes]) -> zstd.ZstdCompressionDict:
    """A dictionary from an archive's first records; where they are too few, the first ones as raw content."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n", dict_type=zstd.DICT_TYPE_RAWCONTENT)


class Archive:
    """One archive being written; append() gives False once it is full."""

    def __init__(self, folder: str):
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.uri, self.out = f"{folder}/{name}", system.open_output_stream(f"{path}/{name}")
        self.waiting, self.held, self.size, self.records, self.packer = [], 0, 0, 0, None

    def append(self, record: bytes) -> bool:
        self.records += 1
        if self.packer:
            self._put(self.packer.compress(record))
        else:
            self.waiting.append(record)
            self.held += len(record)
            if len(self.waiting) >= SAMPLE_RECORDS or self.held >= SAMPLE_BYTES:
                self._start()
        return self.size < ARCHIVE_BYTES

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _start(self) -> None:
        words = train(self.waiting)
        raw = words.as_bytes()
        self._put(struct.pack("<II", SKIPPABLE_DICTIONARY, len(raw)) + raw)
        self.packer = zstd.ZstdCompressor(level=3, dict_data=words, write_checksum=True, write_content_size=True)
        for x in self.waiting:
            self._put(self.packer.compress(x))
        self.waiting = []

    def close(self) -> None:
        if not self.packer:
            self._start()
        self.out.close()


def records(stream, size: int = READ_BYTES, most: int = RECORD_BYTES) -> Iterator[Record]:
    """The records of an archive, given a file-like object of its bytes; none may decode to more than `most` bytes."""
    head = stream.read(8)
    if len(head) < 8:
        raise BadArchive("no dictionary frame")
    magic, n = struct.unpack("<II", head)
    if magic != SKIPPABLE_DICTIONARY:
        raise BadArchive(f"it begins with {magic:#x}, not a dictionary frame")
    raw = stream.read(n)
    if len(raw) != n:
        raise BadArchive("the dictionary frame is cut off")
    if raw[:4] == ZSTD_MAGIC:
        raw = zstd.ZstdDecompressor().decompress(raw)
    opener = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(raw))
    rest, number = b"", 0
    while True:
        rest = rest or stream.read(size)
        if not rest:
            return
        frame, parts, held = opener.decompressobj(), [], 0
        try:
            while not frame.eof:
                parts.append(frame.decompress(rest[:FEED_BYTES]))
                held += len(parts[-1])
                if held > most:
                    raise BadArchive(f"more than {most} bytes")
                rest = (frame.unused_data if frame.eof else b"") + rest[FEED_BYTES:]
                if not frame.eof and not rest:
                    rest = stream.read(size)
                    if not rest:
                        raise BadArchive("the last frame is cut off")
            yield decode(b"".join(parts))
        except (BadArchive, zstd.ZstdError, UnicodeDecodeError) as e:
            raise BadArchive(f"record {number}: {e}") from e
        number += 1


def write_archives(rows: DataFrame, label: str = "warc") -> DataFrame:
    """Write the rows (id long, uri string, body binary, sha1 hex string, refers_to long, revisit boolean) as archives.

    Gives one row (archive, records, bytes) per archive. Names are new in every task attempt, and only archives of
    attempts that succeeded are listed, so retried or lost tasks leave files that nobody reads.
    """
    folder = shared_dir(rows.sparkSession, label)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, archive = [], None
        for batch in batches:
            for page, uri, body, sha1, refers, revisit in zip(*(batch.column(x).to_pylist() for x in ("id", "uri", "body", "sha1", "refers_to", "revisit")), strict=True):
                if archive is None:
                    archive = Archive(folder)
                    archive.append(encode({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": "2024-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                if not archive.append(page_record(page, uri, body, sha1, refers if revisit else None, revisit)):
                    archive.close()
                    done.append(archive)
                    archive = None
        if archive:
            archive.close()
            done.append(archive)
        yield pa.RecordBatch.from_arrays([pa.array([x.uri for x in done], pa.string()), pa.array([x.records for x in done], pa.int64()), pa.array([x.size for x in done], pa.int64())], names=["archive", "records", "bytes"])

    return cut(map_arrow(rows.select("id", "uri", "body", "sha1", "refers_to", "revisit"), write, "archive string, records long, bytes long"), f"{label}-list")


def page_record(page: int | None, uri: str | None, body: bytes, sha1: str, refers: int | None, revisit: bool) -> bytes:
    """One response, or a revisit without payload; a null id or URI is left out."""
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or "")
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:page:{page}>" if page is not None else f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": "2024-01-01T00:00:00Z"}
    head |= {"WARC-Target-URI": clean} if clean else {}
    head |= {"WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(), "X-Payload-Length": str(len(body)), "Content-Type": "application/http; msgtype=response"}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    if revisit:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{refers}>"}
        return encode(head, http)
    return encode(head, http + body)


_PAGE = re.compile(r"<urn:page:(-?\d+)>")
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The page records of archives (column archive holds URIs): READ_SCHEMA, and payload binary if asked for.

    Every header, length, frame checksum and payload digest is checked; anything wrong raises BadArchive, which names
    the archive and the record. uri is null where the record has none.
    """
    schema = READ_SCHEMA + (", payload binary" if with_payload else "")

    def rows(uri: str) -> Iterator[tuple]:
        system, path = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(path) as stream:
            try:
                for x in records(stream):
                    h = x.headers
                    if h["warc-type"] not in ("response", "revisit"):
                        continue
                    body, named = payload(x), h.get("warc-payload-digest", "").removeprefix("sha1:")
                    revisit = h["warc-type"] == "revisit"
                    if not revisit and digest(body) != named:
                        raise BadArchive(f"{h['warc-record-id']}: payload digest differs")
                    if revisit and (body or "warc-refers-to" not in h or h.get("warc-profile") != REVISIT_PROFILE):
                        raise BadArchive(f"{h['warc-record-id']}: bad revisit")
                    n = int(h.get("x-payload-length", len(body)))
                    if not revisit and n != len(body):
                        raise BadArchive(f"{h['warc-record-id']}: payload of {len(body)} bytes, not {n}")
                    page, refers = _PAGE.fullmatch(h["warc-record-id"]), _PAGE.fullmatch(h.get("warc-refers-to", ""))
                    yield (int(page[1]) if page else None, n, named, h["warc-type"], int(refers[1]) if refers else None, h.get("warc-target-uri"), *((body,) if with_payload else ()))
            except BadArchive as e:
                raise BadArchive(f"{uri}: {e}") from e

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), *([("payload", pa.binary())] if with_payload else [])])
        for batch in batches:
            held = []
            for uri in batch.column("archive").to_pylist():
                for row in rows(uri):
                    held.append(row)
                    if len(held) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], schema=kinds)
                        held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], schema=kinds)

    # A task for each archive, up to many thousands: one is bounded in size, so tasks are alike.
    spread = archives.select("archive").repartition(max(1, min(10_000, archives.count())), "archive")
    return map_arrow(spread, read, schema)


def bad_revisits(read: DataFrame) -> DataFrame:
    """Of rows as read_archives gives them: the revisits whose payload's digest and length are not those of a response with the
    id they refer to. Only narrow columns meet."""
    first = read.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    return read.where("record_type = 'revisit'").join(first, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")


def with_revisits(pages: DataFrame, page: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """The rows write_archives takes: of equal payloads of at least REVISIT_BYTES bytes, all but those with the smallest id are revisits.

    A null html is the empty payload. Repeated rows of the smallest id are responses alike; a null id is a revisit where
    any id is known, else a response. The digest is aggregated per task first; only groups of two and more are joined, and
    payloads are shuffled for that only where those groups are too many to broadcast.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page).cast("long").alias("id"), F.col(uri).cast("string").alias("uri"), body.alias("body")).withColumn("sha1", F.sha1("body"))
    firsts = rows.where(F.length("body") >= REVISIT_BYTES).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first")
    firsts = hinted(cut(firsts, "warc-groups"), BROADCAST_GROUPS)
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")), F.lit(False))
    return rows.join(firsts, "sha1", "left").select("id", "uri", "body", "sha1", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def round_trip(pages: DataFrame, page: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """Write pages as archives and read them back: READ_SCHEMA, one row per row of pages. An empty table gives no rows."""
    return read_archives(write_archives(with_revisits(pages, page, uri, html)))
