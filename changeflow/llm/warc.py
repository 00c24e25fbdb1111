"""WARC archives with Zstandard: a dictionary in a leading skippable frame, then one frame per record.

Records are written by the tasks that hold the pages, below the shared folder;
the table of finished archives is what counts, so files of failed or repeated
attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.session import work_dir

ARCHIVE_BYTES = 64 * 1024 * 1024  # an archive is closed behind the record that reaches this size, waiting ones included
SAMPLE_BYTES = 1024 * 1024  # first records of an archive that its dictionary is trained on
DICTIONARY = 32 * 1024
LEVEL = 3
SALTS = 16
BROADCAST_ROWS = 500_000  # digests of repeated payloads (40 bytes each) sent to all executors, at most

#: Fixed by the format.
VERSION = "WARC/1.1"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PAGE_URN = re.compile(r"<urn:page:(-?\d+|none)>")
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, archive string, problem string"
)


class WarcError(ValueError):
    """A record or an archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def planned(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """`page_id, url, payload, record_type, refers_to` for every row of `pages`.

    Of equal payloads (same SHA-1 and length) of at least `revisit_from` bytes
    the one with the largest page id is the response and others revisit it. Rows
    that repeat that largest id are all responses; a payload whose rows all lack
    an id is a response each time. A null `html` is an empty payload.

    Only digests are grouped. Digests of repeated payloads are sent to all
    executors where they are few; otherwise they join by shuffle, copies dealt
    to `SALTS` parts so that no payload's copies meet in one task.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("payload")
    )
    rows = rows.withColumns({"sha": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    shared = (
        rows.filter(F.col("size") >= revisit_from)
        .groupBy("sha", "size")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .filter("n > 1 and largest is not null")
        .select("sha", "size", "largest")
    )
    if shared.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(shared), ["sha", "size"], "left")
    else:
        salts = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(salts, ["sha", "size", "salt"], "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit keeps the HTTP header, with the length of the full payload, and leaves the payload out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if kind == "response" else b"")
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>"]
    lines.append(f"WARC-Date: {date}")
    if url is not None:
        safe = "".join(c if 32 < ord(c) != 127 else f"%{ord(c):02X}" for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"Content-Type: {HTTP_TYPE}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Archive:
    """Writes one archive. The first records wait until there is enough to train the dictionary on."""

    def __init__(self, stream):
        self.stream, self.waiting, self.held = stream, [], 0
        self.compressor = None
        self.size = self.records = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.compressor is None:
            self.waiting.append(data)
            self.held += len(data)
            if self.held >= SAMPLE_BYTES:
                self._begin()
        else:
            self._put(self.compressor.compress(data))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def _begin(self) -> None:
        try:
            trained = zstandard.train_dictionary(DICTIONARY, self.waiting, level=LEVEL)
        except zstandard.ZstdError:  # too few records to train on
            self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        else:
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
            packed = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        for data in self.waiting:
            self._put(self.compressor.compress(data))
        self.waiting, self.held = [], 0

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.stream.close()


def write(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write what `planned` gave as archives in `folder`; the table of finished archives: `path, records, bytes`.

    Any location that Arrow's file systems reach will do. The table is written
    below the shared folder before it is returned: it names one attempt's
    archives for every part of the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        done: list[tuple] = []
        archive, path = None, ""
        for batch in batches:
            for page_id, url, payload, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):04d}.warc.zst"
                    path = f"{root}/{name}"
                    archive = Archive(store.open_output_stream(path))
                archive.add(record(page_id, url, payload.encode(), kind, refers_to, date))
                if archive.size + archive.held >= archive_bytes:
                    archive.close()
                    done.append((f"{folder}/{name}", archive.records, archive.size))
                    archive = None
        if archive is not None:
            archive.close()
            done.append((f"{folder}/{name}", archive.records, archive.size))
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "records", "bytes"]
        )

    table = work_dir(plan.sparkSession, "archives")
    plan.select("page_id", "url", "payload", "record_type", "refers_to").mapInArrow(run, MANIFEST).write.parquet(table)
    return plan.sparkSession.read.schema(MANIFEST).parquet(table)


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The contents of an archive's frames, one after another, reading `chunk` bytes at a time."""
    data = stream.read(8)
    dictionary = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", data[4:])[0]
        raw = stream.read(size)
        if len(raw) < size:
            raise WarcError("the dictionary frame is cut off")
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
        dictionary, data = zstandard.ZstdCompressionDict(raw), b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        while len(data) < 8 and (more := stream.read(chunk)):
            data += more
        if not data:
            return
        if len(data) >= 8 and struct.unpack("<I", data[:4])[0] in SKIPPABLE:
            size = 8 + struct.unpack("<I", data[4:8])[0]
            while len(data) < size and (more := stream.read(chunk)):
                data += more
            if len(data) < size:
                raise WarcError("a skippable frame is cut off")
            data = data[size:]
            continue
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise WarcError(f"not a Zstandard frame: {e}") from e
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(chunk)
            if not data:
                raise WarcError("the last frame is cut off")
        yield b"".join(parts)


@dataclass
class Parsed:
    page_id: int | None
    url: str | None
    kind: str
    refers_to: int | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def _fields(lines: list[str]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, mark, value = line.partition(":")
        if not mark or not name.strip():
            raise WarcError(f"not a header field: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    return fields


def _length(fields: dict[str, str], where: str) -> int:
    value = fields.get("content-length", "")
    if not value.isdecimal():
        raise WarcError(f"{where}: no length")
    return int(value)


def _page(value: str, what: str) -> int | None:
    m = PAGE_URN.fullmatch(value)
    if not m:
        raise WarcError(f"{what} names no page: {value[:80]!r}")
    return None if m[1] == "none" else int(m[1])


def parse(data: bytes) -> Parsed:
    """The record that a frame holds, with headers, lengths and digest checked."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        raise WarcError("the header has no end")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version not in (VERSION, "WARC/1.0"):
        raise WarcError(f"not a WARC version: {version[:40]!r}")
    fields = _fields(lines)
    missing = [f for f in REQUIRED if f not in fields]
    if missing:
        raise WarcError(f"header fields are missing: {', '.join(missing)}")
    size = _length(fields, "record")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"the frame holds {len(rest) - 4} bytes of block, the header says {size}")
    block, kind = rest[:size], fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unknown record type {kind[:40]!r}")
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not mark:
        raise WarcError("the HTTP header has no end")
    full = _length(_fields(http.decode("utf-8").split("\r\n")[1:]), "HTTP header")
    claimed = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    page_id, url = _page(fields["warc-record-id"], "record id"), fields.get("warc-target-uri")
    if kind == "revisit":
        if payload or fields.get("warc-profile") != PROFILE or not claimed:
            raise WarcError("a revisit needs the profile and a digest, and has no payload")
        return Parsed(page_id, url, kind, _page(fields.get("warc-refers-to", ""), "reference"), full, claimed, None)
    if len(payload) != full:
        raise WarcError(f"the payload has {len(payload)} bytes, the HTTP header says {full}")
    if claimed != digest(payload):
        raise WarcError("the payload does not have the digest of the header")
    return Parsed(page_id, url, kind, None, full, claimed, payload)


def read(archives: DataFrame, strict: bool = True, payloads: bool = True) -> DataFrame:
    """One row per record of the archives that `path` names, streamed frame by frame.

    A broken record or archive raises `WarcError`; with `strict=False` it gives
    a row that has only `archive` and `problem`, and reading goes on with the
    next record, or the next archive if frames cannot be told apart any more.
    """

    def rows(path: str) -> Iterator[tuple]:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_stream(place) as stream:
            try:
                for data in frames(stream):
                    try:
                        r = parse(data)
                    except (WarcError, UnicodeDecodeError) as e:
                        if strict:
                            raise
                        yield (*[None] * 7, path, str(e))
                    else:
                        body = r.payload if payloads else None
                        yield r.page_id, r.url, r.kind, r.refers_to, r.payload_bytes, r.payload_digest, body, path, None
            except WarcError as e:
                if strict:
                    raise WarcError(f"{path}: {e}") from e
                yield (*[None] * 7, path, str(e))

    names = [c.split()[0] for c in RECORD.split(", ")]
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [arrow[c.split()[1]] for c in RECORD.split(", ")]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found, size = [], 0
                for row in rows(path):
                    found.append(row)
                    size += len(row[6] or b"")
                    if len(found) >= 5000 or size >= 1 << 23:
                        yield batch_of(found)
                        found, size = [], 0
                yield batch_of(found)

    # One archive per task: a table of paths would otherwise be a single task.
    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The pages written as archives below the shared folder and read back, without their payloads."""
    folder = work_dir(pages.sparkSession, "warc")
    return read(write(planned(pages), folder, archive_bytes), payloads=False)
