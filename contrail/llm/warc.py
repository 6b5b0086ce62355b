"""WARC archives as seekable Zstandard bundles.

A bundle is a sequence of independent frames, each holding whole WARC records, followed by a skippable frame with the
seek table: compressed size, size and checksum of every frame. Any Zstandard tool unpacks a bundle; who has a frame's
place in it reads that frame alone. The index maps every record identifier to bundle, frame and the offset in the frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.tables import landed
from contrail.session import work_dir

# Fixed values of the seekable format: magic numbers of the skippable frame and of the table's end, the flag for
# checksums; and of WARC: the revisit profile.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "contrail:warc")

_FRAMES = "bundle string, frame int, frame_offset long, frame_bytes long, size long, checksum long"
_INDEX = ("record_id string, key string, record_type string, bundle string, frame int, frame_offset long, "
          "frame_bytes long, offset long, length long")


@dataclass(frozen=True)
class Archive:
    """Bundles in a folder and the index of their records. Files that the index does not name belong to no archive:
    they were left behind by lost tasks."""

    index: DataFrame
    key_type: str

    @property
    def spark(self) -> SparkSession:
        return self.index.sparkSession


# ---- bundles

class BundleWriter:
    """Writes records into frames of about ``frame_bytes``; ``close`` appends the seek table."""

    def __init__(self, file: BinaryIO, frame_bytes: int, level: int):
        self.file, self.frame_bytes = file, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.size = self.at = 0
        self.table: list[tuple[int, int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Returns the frame of the record and its offset in it."""
        place = len(self.table), self.size
        self.pending.append(record)
        self.size += len(record)
        return place

    def full(self) -> bool:
        return self.size >= self.frame_bytes

    def flush(self) -> tuple[int, int]:
        """Writes the pending records as a frame; returns where it begins and how long it is."""
        data = b"".join(self.pending)
        frame = self.packer.compress(data)
        self.file.write(frame)
        begin, self.at = self.at, self.at + len(frame)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.pending, self.size = [], 0
        return begin, len(frame)

    def close(self) -> None:
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), _CHECKSUMS, _SEEKABLE)
        self.file.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.file.close()


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int, int]]:
    """Offset, compressed size, size and checksum of every frame, from the end of a bundle."""
    total = file.size()
    file.seek(total - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & _CHECKSUMS else 8
    file.seek(total - 9 - count * width)
    out, at = [], 0
    for entry in struct.iter_unpack("<III" if width == 12 else "<II", file.read(count * width)):
        out.append((at, entry[0], entry[1], entry[2] if width == 12 else -1))
        at += entry[0]
    return out


def read_frame(file: pa.NativeFile, offset: int, length: int) -> bytes:
    file.seek(offset)
    return zstandard.ZstdDecompressor().decompress(file.read(length))


# ---- records

def _header(name: str, value: object) -> bytes:
    return f"{name}: {value}\r\n".encode()


def record_id(key: str | None, digest: str, kind: str) -> str:
    """The same for the same key, payload and kind of record, so a revisit can name its response unseen."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{kind} {digest} {key!r}')}>"


def build_record(key: str | None, url: str | None, payload: bytes, sha1: bytes, revisit_of: str | None, is_revisit: bool,
                 date: str) -> tuple[str, bytes]:
    """A response, or the revisit of the response with the key ``revisit_of``. The HTTP header of both has the payload's
    length. Line breaks of a url are percent-encoded. Returns the record's identifier and its bytes."""
    digest = base64.b32encode(sha1).decode()
    kind = "revisit" if is_revisit else "response"
    name = record_id(key, digest, kind)
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + _header("Content-Length", len(payload)) + b"\r\n")
    block = http if is_revisit else http + payload
    head = [b"WARC/1.1\r\n", _header("WARC-Type", kind), _header("WARC-Record-ID", name), _header("WARC-Date", date),
            _header("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
            _header("WARC-Payload-Digest", f"sha1:{digest}"),
            _header("Content-Type", "application/http; msgtype=response"), _header("Content-Length", len(block))]
    if key is not None:
        head.append(_header("X-Key", quote(key, safe="")))
    if is_revisit:
        head += [_header("WARC-Profile", _PROFILE), _header("WARC-Refers-To", record_id(revisit_of, digest, "response"))]
        if revisit_of is not None:
            head.append(_header("X-Refers-To-Key", quote(revisit_of, safe="")))
    return name, b"".join([*head, b"\r\n", block, b"\r\n\r\n"])


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    payload: bytes | None
    payload_bytes: int
    payload_digest: str

    def key(self, header: str) -> str | None:
        value = self.headers.get(header)
        return None if value is None else unquote(value)


def _headers(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n")[1:])


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at ``at`` and where the next one does. A payload that does not have its digest is an
    error."""
    end = data.index(b"\r\n\r\n", at)
    headers = _headers(data[at:end])
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    cut = data.index(b"\r\n\r\n", begin, stop) + 4
    length = int(_headers(data[begin:cut - 4])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if headers["WARC-Type"] == "response":
        payload = data[cut:stop]
        if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return Record(headers, payload, length, digest), stop + 4


# ---- writing

def with_roles(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """The pages as ``key`` and ``url`` (text), ``payload`` (bytes; null: empty), ``sha1``, ``revisit``, ``first``.

    Of rows with equal payloads of at least ``min_bytes``, those with the smallest key are responses and all others
    revisit them, also rows with a null key; where all keys are null, all are responses. Rows repeated with key and
    payload are the same record written again. Payloads are equal when length and SHA-1 are. Only payloads that several
    keys have are joined back, so the pages themselves move only where that table is too large to be sent around.
    """
    text = F.col(f"`{payload}`").cast("string")
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"),
        F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    each = rows.filter(F.length("payload") >= min_bytes).groupBy("sha1", F.length("payload").alias("bytes")).agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count("key").alias("keys"), F.count("*").alias("n"))
    several = landed(each.filter((F.col("keys") > 0) & ((F.col("first") < F.col("last")) | (F.col("keys") < F.col("n"))))
                     .select("sha1", "bytes", "first"), "warc-repeated")
    found = rows.join(several, (rows["sha1"] == several["sha1"]) & (F.length("payload") == several["bytes"]), "left")
    revisit = several["first"].isNotNull() & ~F.col("key").eqNullSafe(several["first"])
    return found.select(F.col("key").cast("string").alias("key"), "url", "payload", rows["sha1"],
                        revisit.alias("revisit"), several["first"].cast("string").alias("first"))


def write_archive(pages: DataFrame, key: str, url: str, payload: str, folder: str | None = None, min_bytes: int = 0,
                  frame_bytes: int = 1 << 20, bundle_bytes: int = 1 << 30, level: int = 3,
                  date: str = "1970-01-01T00:00:00Z") -> Archive:
    """One WARC record for each row (see ``with_roles``), in bundles under ``folder`` (default: a new one in the shared
    work folder), which every executor must reach. A task writes bundles of up to ``bundle_bytes``, holds one frame in
    memory and never continues another attempt's file; the index names the files of the attempts that counted.
    """
    spark = pages.sparkSession
    place = folder or work_dir(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = FileSystem.from_uri(place)
        system.create_dir(base, recursive=True)
        writer, path = None, ""
        rows: list[tuple] = []

        def frame() -> list[tuple]:
            number = len(writer.table)
            begin, length = writer.flush()
            out = [(n, k, t, path, number, begin, length, at, size) for n, k, t, at, size in rows]
            rows.clear()
            return out

        def shaped(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            kinds = [pa.string()] * 4 + [pa.int32()] + [pa.int64()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

        names = [part.split()[0] for part in _INDEX.split(", ")]
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if writer is None:
                        path = f"{uuid.uuid4().hex}.warc.zst"
                        writer = BundleWriter(system.open_output_stream(f"{base}/{path}", compression=None),
                                              frame_bytes, level)
                    name, data = build_record(row["key"], row["url"], row["payload"], row["sha1"], row["first"],
                                              row["revisit"], date)
                    _, at = writer.add(data)
                    rows.append((name, row["key"], "revisit" if row["revisit"] else "response", at, len(data)))
                    if writer.full():
                        yield shaped(frame())
                        if writer.at >= bundle_bytes:
                            writer.close()
                            writer = None
            if writer is not None:
                last = shaped(frame()) if rows else None
                writer.close()
                writer = None
                if last is not None:
                    yield last
        finally:
            if writer is not None:  # given up half-way
                writer.file.close()

    index = with_roles(pages, key, url, payload, min_bytes).mapInArrow(write, _INDEX)
    named = index.withColumn("bundle", F.concat(F.lit(place.rstrip("/") + "/"), "bundle"))
    return Archive(landed(named, "warc-index"), dict(pages.dtypes)[key])


# ---- reading

def _open(path: str) -> pa.NativeFile:
    system, base = FileSystem.from_uri(path)
    return system.open_input_file(base)


def _tasks(archive: Archive, given: int | None) -> int:
    """Frames are a few bytes each until they are opened, so their number of tasks is set by what they unpack to."""
    if given:
        return given
    unpacked = archive.index.agg(F.sum("length")).first()[0] or 0
    return max(int(archive.spark.conf.get("spark.sql.shuffle.partitions")), -(-unpacked // (1 << 30)))


def frames(archive: Archive) -> DataFrame:
    """Every frame of every bundle, from the seek tables at their ends."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _open(path) as file:
                    table = seek_table(file)
                columns = [[path] * len(table), range(len(table)), *zip(*table)]
                kinds = [pa.string(), pa.int32()] + [pa.int64()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 [part.split()[0] for part in _FRAMES.split(", ")])

    return archive.index.select("bundle").distinct().mapInArrow(look, _FRAMES)


def _shaped(records: list[Record], with_payload: bool) -> pa.RecordBatch:
    columns = {
        "record_id": pa.array([r.headers["WARC-Record-ID"] for r in records], pa.string()),
        "key": pa.array([r.key("X-Key") for r in records], pa.string()),
        "url": pa.array([r.headers["WARC-Target-URI"] for r in records], pa.string()),
        "record_type": pa.array([r.headers["WARC-Type"] for r in records], pa.string()),
        "refers_to": pa.array([r.key("X-Refers-To-Key") for r in records], pa.string()),
        "payload_bytes": pa.array([r.payload_bytes for r in records], pa.int64()),
        "payload_digest": pa.array([r.payload_digest for r in records], pa.string()),
    }
    if with_payload:
        columns["payload"] = pa.array([r.payload for r in records], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def _typed(found: DataFrame, archive: Archive) -> DataFrame:
    return found.withColumns({c: F.col(c).cast(archive.key_type) for c in ("key", "refers_to")})


_RECORDS = ("record_id string, key string, url string, record_type string, refers_to string, payload_bytes long, "
            "payload_digest string")


def read_archive(archive: Archive, with_payload: bool = True, tasks: int | None = None) -> DataFrame:
    """All records of the archive, read from its bundles frame by frame, each payload held against its digest.

    ``payload`` is null for revisits; ``payload_bytes`` and ``payload_digest`` are those of the full payload. An
    unpacked frame is held against the seek table's checksum; a damaged one is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                with _open(f["bundle"]) as file:
                    data = read_frame(file, f["frame_offset"], f["frame_bytes"])
                if len(data) != f["size"] or f["checksum"] not in (-1, xxhash.xxh64_intdigest(data) & 0xFFFFFFFF):
                    raise ValueError(f"damaged frame {f['frame']} of {f['bundle']}")
                records, at = [], 0
                while at < len(data):
                    record, at = parse_record(data, at)
                    records.append(record)
                yield _shaped(records, with_payload)

    dealt = frames(archive).repartition(_tasks(archive, tasks), "bundle", "frame")
    return _typed(dealt.mapInArrow(read, _RECORDS + ", payload binary" * with_payload), archive)


def fetch(archive: Archive, ids: DataFrame, tasks: int | None = None) -> DataFrame:
    """The records with the identifiers ``ids.record_id``: only frames that hold one of them are read, each once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, data = None, b""
        for batch in batches:
            records = []
            for r in batch.to_pylist():
                if last != (r["bundle"], r["frame"]):
                    last = r["bundle"], r["frame"]
                    with _open(r["bundle"]) as file:
                        data = read_frame(file, r["frame_offset"], r["frame_bytes"])
                records.append(parse_record(data, r["offset"])[0])
            if records:
                yield _shaped(records, True)

    wanted = archive.index.join(ids.select("record_id").distinct(), "record_id", "left_semi")
    dealt = wanted.repartition(_tasks(archive, tasks), "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return _typed(dealt.mapInArrow(read, _RECORDS + ", payload binary"), archive)
