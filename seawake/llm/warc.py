"""Dictionary-compressed WARC archives: writer and reader.

An archive (``.warc.zst``) begins with a skippable Zstandard frame (magic number 0x184D2A5D) that
holds the dictionary; every record follows as a frame of its own, compressed with that dictionary,
so records can be read one by one. The dictionary is trained on records drawn at random from the
whole table, at most about ``SAMPLE_RECORDS`` of them, each of at most ``SAMPLE_BYTES`` bytes; every
record is archived.

Payloads of at least ``MIN_DEDUP`` bytes are archived once: of equal ones (same SHA-1, XXH64 and
length) the row with the largest page_id is the response, the others are revisits that carry the
digest and refer to it. Shorter payloads are always responses.

Each task writes the archives of its partition into the shared folder: first under a name of its
own attempt, then moved to the final name, so a repeated or speculative task leaves no half
archive. The manifest (one row per archive) is a table; archives are read back one per row.

Edge cases: null html is an empty payload; a null url leaves the target header out; rows with a
null page_id are archived with the id ``none`` and never become the referred response unless all equal
payloads lack an id, in which case all are responses; rows repeated with the same page_id and
payload are all responses if that id is the largest; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import BATCH_ROWS, prepare, scratch_dir, table

# Fixed values of the formats.
DICT_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_DEDUP = 1000
LEVEL = 6
DICT_BYTES = 64 << 10
SAMPLE_RECORDS = 1500
SAMPLE_BYTES = 32 << 10
ARCHIVE_BYTES = 1 << 30      # a partition starts a new archive beyond this size
READ_BYTES = 64 << 10
SEED = 5

MANIFEST = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType()),
                         T.StructField("bytes", T.LongType())])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType())])
RECORD_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html and ``original``: the page_id to refer to, null where the row is a response."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"))
    key = [F.sha1(F.col("html").cast("binary")).alias("sha1"), F.xxhash64("html").alias("xxh"),
           F.octet_length("html").alias("size")]
    firsts = (rows.select("page_id", *key).where(F.col("size") >= MIN_DEDUP).groupBy("sha1", "xxh", "size")
              .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = rows.select("*", *key).join(firsts, ["sha1", "xxh", "size"], "left")
    original = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.select("page_id", "url", "html", original.alias("original"))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    tail = urn.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and drops the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if original is None else http
    head = [("WARC-Type", "response" if original is None else "revisit"), ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Date", DATE),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c >= " " else f"%{ord(c):02X}" for c in url)))
    if original is not None:
        head += [("WARC-Refers-To", _urn(original)), ("WARC-Profile", PROFILE)]
    lines = CRLF.join(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in head)
    return VERSION + CRLF + lines + CRLF + CRLF + block + CRLF + CRLF


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, payload digest, record type, refers_to) of one record, checked."""
    head, _, rest = data.partition(CRLF + CRLF)
    first, *lines = head.split(CRLF)
    if first != VERSION:
        raise ValueError("not a WARC record")
    fields = {k.decode(): v.decode("utf-8", "surrogatepass") for k, _, v in (x.partition(b": ") for x in lines)}
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != CRLF + CRLF:
        raise ValueError("a record ends with two line ends")
    http, _, payload = block.partition(CRLF + CRLF)
    size = int(next(x for x in http.split(CRLF) if x.startswith(b"Content-Length: "))[16:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload differs from its digest")
    refers = fields.get("WARC-Refers-To")
    return _page(fields["WARC-Record-ID"]), size, digest, kind, refers and _page(refers)


def train(pages: DataFrame, sample_records: int = SAMPLE_RECORDS, dict_bytes: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary from a random sample of records; too few records give their plain bytes."""
    total = pages.count()
    sample = pages if total <= sample_records else pages.sample(fraction=sample_records / total, seed=SEED)
    rows = sample.where(F.octet_length(F.coalesce("html", F.lit(""))) <= SAMPLE_BYTES) \
        .select("page_id", "url", "html").limit(2 * sample_records).collect()
    samples = [record(r.page_id, r.url, (r.html or "").encode("utf-8", "surrogatepass"), None) for r in rows]
    try:
        return zstd.train_dictionary(dict_bytes, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-dict_bytes:]


def _filesystem(root: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder name, from its scheme.

    Spark's spellings are taken too: ``file:/x`` is ``file:///x``, and ``s3a://`` and ``s3n://`` are ``s3://``. ``hdfs://`` needs
    libhdfs on every worker.
    """
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root.removeprefix("file:")
    scheme, colon, rest = root.partition("://")
    if scheme in ("s3a", "s3n"):
        root = f"s3{colon}{rest}"
    return fs.FileSystem.from_uri(root)


class Archive:
    """An archive being written under a temporary name."""

    def __init__(self, root: str, name: str, dictionary: bytes):
        self.store, folder = _filesystem(root)
        self.name, self.path = name, f"{folder}/{name}"
        self.temp = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temp, compression=None)
        self.records = self.bytes = 0
        if dictionary:
            self._put(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, frame: bytes) -> None:
        self._put(frame)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        self.store.move(self.temp, self.path)
        return self.name, self.records, self.bytes


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Archive every row of ``pages`` under ``root``; the manifest, written there as a table too."""
    spark = prepare(pages.sparkSession)
    dictionary = train(pages)
    store, folder = _filesystem(root)
    store.create_dir(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        if held:
            held.precompute_compress(level=LEVEL)
        packer = zstd.ZstdCompressor(level=LEVEL, dict_data=held)
        part, done, archive = TaskContext.get().partitionId(), [], None
        for b in batches:
            for page_id, url, html, original in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if archive is None:
                    archive = Archive(root, f"pages-{part:06d}-{len(done):04d}.warc.zst", dictionary)
                archive.add(packer.compress(record(page_id, url, html.encode("utf-8", "surrogatepass"), original)))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=MANIFEST.names)

    planned(pages).mapInArrow(run, MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def frames(source: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an archive, given its bytes in chunks; holds one record at a time."""
    buffer = b""
    while len(buffer) < 8 and (chunk := next(source, b"")):
        buffer += chunk
    held = None
    if len(buffer) >= 8 and struct.unpack("<I", buffer[:4])[0] == DICT_FRAME:
        size = 8 + struct.unpack("<I", buffer[4:8])[0]
        while len(buffer) < size and (chunk := next(source, b"")):
            buffer += chunk
        held, buffer = zstd.ZstdCompressionDict(buffer[8:size]), buffer[size:]
    unpacker = zstd.ZstdDecompressor(dict_data=held)
    frame, out = unpacker.decompressobj(), []
    while buffer or (buffer := next(source, b"")):
        out.append(frame.decompress(buffer))
        buffer = frame.unused_data if frame.eof else b""
        if frame.eof:
            yield b"".join(out)
            frame, out = unpacker.decompressobj(), []
    if any(out):
        raise ValueError("the archive ends inside a record")


def read_archives(manifest: DataFrame, root: str) -> DataFrame:
    """Every record of the archives that ``manifest`` lists."""

    def chunks(name: str) -> Iterator[bytes]:
        store, folder = _filesystem(root)
        with store.open_input_stream(f"{folder}/{name}", compression=None) as f:
            while data := f.read(READ_BYTES):
                yield data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, expected in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows, seen = [], 0
                for data in frames(chunks(name)):
                    rows.append(parse(data))
                    seen += 1
                    if len(rows) == BATCH_ROWS:
                        yield _records(rows)
                        rows = []
                if seen != expected:
                    raise ValueError(f"{name} holds {seen} records, not {expected}")
                if rows:
                    yield _records(rows)

    tasks = max(1, manifest.count())      # one archive per task, whatever the shuffle settings
    return manifest.repartition(tasks).mapInArrow(run, RECORDS)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), RECORD_KINDS, strict=True)], names=RECORDS.names)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    root = scratch_dir(spark, "warc")
    return read_archives(write_archives(pages, root), root)


ORACLE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= {MIN_DEDUP}
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
