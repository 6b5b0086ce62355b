"""Bundles, records and archives."""

import base64
import hashlib
import io
import os
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from contrail.llm import warc

PAGES = [(5, "http://a.net/x", "<p>same</p>"), (3, "http://b.net/\r\ny", "<p>same</p>"), (None, None, "<p>same</p>"),
         (9, "http://c.net/%20é", None), (10, "http://d.net", ""), (11, "", "é" * 70_000), (12, "u", "w\r\n\r\nWARC/1.1\r\n"),
         (None, "n", "lonely"), (None, "n", "lonely"), (20, "t", "twice"), (20, "t", "twice"), (21, "t", "twice")]


def frame(spark, rows=PAGES):
    # Extra columns with the operator's own working names.
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("z") for c in ("key", "payload", "sha1", "first", "bundle", "record_id")}).repartition(3)


def by_plain(rows, min_bytes=0):
    out, least = [], {}
    data = [(k, (h or "").encode()) for k, _, h in rows]
    for k, p in data:
        if k is not None and len(p) >= min_bytes:
            least[p] = min(k, least.get(p, k))
    for k, p in data:
        first = least.get(p)
        revisit = first is not None and k != first
        out.append((k, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


def rows_of(found):
    return sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 1, 6])
def test_archives_come_back_as_written(spark, tmp_path, min_bytes):
    archive = warc.write_archive(frame(spark), "page_id", "url", "html", str(tmp_path), min_bytes, frame_bytes=200)
    found = warc.read_archive(archive)
    assert rows_of(found) == by_plain(PAGES, min_bytes)
    texts = {(r.key, r.payload_digest): r for r in found.collect()}
    for key, _, html in PAGES:
        row = texts[key, base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()]
        assert row.payload == (None if row.record_type == "revisit" else (html or "").encode())
    assert {r.key: r.url for r in found.collect()}[9] == "http://c.net/%20é"


def test_bundles_are_plain_archives_with_a_seek_table(spark, tmp_path):
    warc.write_archive(frame(spark).coalesce(1), "page_id", "url", "html", str(tmp_path), frame_bytes=300, bundle_bytes=900)
    files = [f for f in os.listdir(tmp_path) if f.endswith(".warc.zst")]
    assert len(files) > 1
    seen = 0
    for name in files:
        path = tmp_path / name
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
        with warc._open(str(path)) as file:
            table = warc.seek_table(file)
            parts = [warc.read_frame(file, at, size) for at, size, _, _ in table]
        assert b"".join(parts) == whole and [len(p) for p in parts] == [size for _, _, size, _ in table]
        seen += len(re.findall(rb"WARC-Record-ID: <urn:uuid:", whole))
    assert seen == len(PAGES)


def test_records_are_fetched_by_identifier(spark, tmp_path):
    archive = warc.write_archive(frame(spark), "page_id", "url", "html", str(tmp_path), frame_bytes=100)
    assert archive.index.select("record_id").distinct().count() == len(PAGES) - 2  # two rows are there twice
    wanted = archive.index.filter("key = 11 or key = 5").select("record_id")
    found = {r.key: r for r in warc.fetch(archive, wanted).collect()}
    assert set(found) == {5, 11} and found[11].payload == ("é" * 70_000).encode()
    assert found[5].refers_to == 3 and found[5].payload is None
    # The index leads to the record itself.
    place = archive.index.filter("key = 11").first()
    with warc._open(place.bundle) as file:
        data = warc.read_frame(file, place.frame_offset, place.frame_bytes)
    assert warc.parse_record(data, place.offset)[1] == place.offset + place.length


def test_damage_is_seen(spark, tmp_path):
    archive = warc.write_archive(frame(spark).coalesce(1), "page_id", "url", "html", str(tmp_path))
    name = next(f for f in os.listdir(tmp_path) if f.endswith(".warc.zst"))
    data = bytearray((tmp_path / name).read_bytes())
    data[len(data) // 3] ^= 255
    (tmp_path / name).write_bytes(bytes(data))
    with pytest.raises(Exception):
        warc.read_archive(archive).collect()


def test_files_of_lost_tasks_are_not_read(spark, tmp_path):
    archive = warc.write_archive(frame(spark), "page_id", "url", "html", str(tmp_path))
    (tmp_path / "left-behind.warc.zst").write_bytes(b"half a frame")
    assert warc.read_archive(archive).count() == len(PAGES)


def test_an_empty_table(spark, tmp_path):
    archive = warc.write_archive(frame(spark).limit(0), "page_id", "url", "html", str(tmp_path))
    assert warc.read_archive(archive).count() == 0
    assert warc.fetch(archive, archive.index.select("record_id")).count() == 0
