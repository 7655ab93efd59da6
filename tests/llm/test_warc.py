import hashlib
import struct
from pathlib import Path

import zstandard as zstd

from seawake.llm import warc
from seawake.llm.common import prepare, scratch_dir

PAGES = "page_id long, url string, html string, sha1 string, first long, size int"


def pages(spark, rows):
    return prepare(spark).createDataFrame([(i, u, h, "x", 1, 2) for i, u, h in rows], PAGES)


def expected(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == data and j is not None]
        first = max(same, default=None)
        revisit = len(data) >= 1000 and first is not None and i != first
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>" + "long page " * 150), (2, "http://a/2", "<p>" + "long page " * 150),
    (9, None, "<p>" + "long page " * 150), (3, "http://a/3\r\nX: y", "short"), (4, "http://a/4", "short"),
    (5, "http://a/5", None), (6, "http://ü/6", ""), (7, "http://a/7", "é" * 500), (8, "http://a/8", "é" * 500),
    (10, "http://a/10", "a" * 999), (11, "http://a/11", "a" * 999), (12, "u", "WARC/1.1\r\n\r\n" * 200),
    (None, "u", "<p>" + "long page " * 150), (13, "u", "z" * 2_000_000), (14, "u", "r" * 1500), (14, "u", "r" * 1500)]


def test_round_trip_equals_brute_force(spark):
    root = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(pages(spark, ROWS), root)
    got = sorted((tuple(r) for r in warc.read_archives(manifest, root).collect()), key=str)
    assert got == expected(ROWS)
    assert sum(r.records for r in manifest.collect()) == len(ROWS)


def test_many_records_and_the_dictionary_frame(spark):
    rows = [(i, f"http://h/{i}", f"<html><body>{'word ' * (i % 50)}{i}</body></html>") for i in range(600)]
    root = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(pages(spark, rows), root)
    assert sorted((tuple(r) for r in warc.read_archives(manifest, root).collect()), key=str) == expected(rows)
    folder = Path(root.removeprefix("file://").removeprefix("file:"))
    archives = sorted(folder.glob("*.warc.zst"))
    assert len(archives) == manifest.count()
    assert not list(folder.glob(".pages*"))                         # no temporary archive is left
    for a in archives:
        raw = a.read_bytes()
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == warc.DICT_FRAME
        held = zstd.ZstdCompressionDict(raw[8:8 + size])
        first = zstd.ZstdDecompressor(dict_data=held).decompressobj().decompress(raw[8 + size:])
        assert first.startswith(b"WARC/1.1\r\n")


def test_rollover_and_small_chunks(spark, monkeypatch):
    rows = [(i, "u", f"page {i} " * 20) for i in range(40)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)
    root = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(pages(spark, rows).coalesce(1), root)
    assert manifest.count() >= 20
    assert warc.read_archives(manifest, root).count() == 40
    data = next(Path(root.removeprefix("file://").removeprefix("file:")).glob("*.zst")).read_bytes()
    assert len(list(warc.frames(data[i:i + 1] for i in range(len(data))))) == 1


def test_empty_table(spark):
    root = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(pages(spark, []), root)
    assert warc.read_archives(manifest, root).count() == 0


def test_spark_spellings_of_file_systems():
    assert warc._filesystem("file:/tmp/x")[1] == warc._filesystem("file:///tmp/x")[1] == "/tmp/x"
    for scheme in ("s3a", "s3n", "s3"):
        store, path = warc._filesystem(f"{scheme}://bucket/folder?region=eu-west-1")
        assert store.type_name == "s3" and path == "bucket/folder"
