"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has bit *b* set when more than half of the XXH64 hashes of its word
shingles (repeats included) have it set. Fingerprints at most ``MAX_BITS`` = 2 bits apart are
linked; the connected components of those links are the near-duplicate groups.

**Search.** A 64-bit fingerprint is cut into four 16-bit segments. Two differing bits touch at
most two segments, so of any linked pair

* either all differing bits lie in one segment, and the other three are equal, or
* exactly one bit differs in each of two segments ``p < q``: dropping ``q``, the rest agrees once
  the bit in ``p`` is flipped, i.e. inside a Hamming ball of radius one around segment ``p``.

Every fingerprint is stored in four tables (one per dropped segment, keyed by the remaining 48
bits) and probes them with its own key and with the radius-one balls of the earlier segments. A
pair differing in one bit is met by whichever side has that bit set, so only set bits are cleared:
about 48 probes on average instead of the 2,081 members of the full ball. Matches are verified on the
complete distance. A table entry holds at most 2^16 different fingerprints however many rows there
are, so no bucket grows with the data.

Copies are folded first: the search runs over *distinct* fingerprints, never over rows.

Edge cases: a null or word-less text has fingerprint zero and links like any other; fewer than
``SHINGLE`` words form one shingle; a null ``doc_id`` keeps its fingerprint and never names a
component (a component of null ids only has a null ``component_id``); repeated rows stay rows;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import hex_of, map_columns, settle, strings, table, unused

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENT = 16
_BLOCK = 1 << 16      # shingles counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one whole text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1, out=starts[1:])
    width = min(shingle, n)
    total = n - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for lo in range(0, total, _BLOCK):
        hi = min(lo + _BLOCK, total)
        spans = zip(starts[lo:hi].tolist(), (starts[lo + width:hi + width] - 1).tolist(), strict=True)
        hashes = b"".join([digest(line[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus the fingerprint of ``text`` in a new column ``out``."""
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = pa.array([fingerprint(x) for x in strings(b.column(at))], pa.int64())
        return pa.RecordBatch.from_arrays([*b.columns, fp], [*b.schema.names, out])

    return map_columns(docs, run, schema)


def _probe_plan() -> list[tuple[int, int]]:
    """(dropped segment, bit to clear) of every probe; bit -1 is the fingerprint's own key."""
    plan = [(q, -1) for q in range(4)]
    return plan + [(q, bit) for q in range(4) for bit in range(SEGMENT * q)]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a < b) of the distinct fingerprints in column ``fp`` at most ``max_bits`` ≤ 2 bits apart."""
    if not 0 <= max_bits <= 2:
        raise ValueError("four segments with balls of radius one cover distances up to 2")

    def keep(q: int) -> int:      # mask of all segments but q, as a signed literal
        m = ~(((1 << SEGMENT) - 1) << (SEGMENT * q)) & ((1 << 64) - 1)
        return m - (1 << 64) if m >> 63 else m

    index = fps.select("fp", F.explode(F.array(*[F.xxhash64(F.lit(q), F.col("fp").bitwiseAND(F.lit(keep(q))))
                                                 for q in range(4)])).alias("key"))
    probes = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(keep(q)).cast("long").alias("keep"),
                                F.lit(0 if bit < 0 else 1 << bit).cast("long").alias("bit"))
                       for q, bit in _probe_plan()])
    probe = (fps.select(F.col("fp").alias("probe_fp"), F.explode(probes).alias("p"))
             .where((F.col("p.bit") == 0) | (F.col("probe_fp").bitwiseAND(F.col("p.bit")) != 0))
             .select("probe_fp", F.xxhash64(F.col("p.q"), F.col("probe_fp").bitwiseAND(F.col("p.keep"))
                                            .bitwiseXOR(F.col("p.bit"))).alias("key"),
                     (F.col("p.bit") == 0).alias("own")))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("probe_fp"))) <= max_bits
    fresh = (F.col("fp") < F.col("probe_fp")) | (~F.col("own") & (F.col("fp") != F.col("probe_fp")))
    # always shuffled: size estimates don't see the explosion, and would broadcast the probes of a small table
    return (probe.join(index.hint("merge"), "key").where(fresh & near)
            .select(F.least("fp", "probe_fp").alias("a"), F.greatest("fp", "probe_fp").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps, each a grouped minimum and a join, until the
    edge table no longer changes. Each round's table is written to the shared folder.
    """
    stars, seen = settle(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
                         .where("v != m"), "links"), None
    while True:
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            return stars.select(F.col("v").alias("node"), F.col("m").alias("root")).union(
                stars.select("m", "m").distinct())
        seen = tuple(mark)
        both = stars.union(stars.select("m", "v")).toDF("u", "w")
        low = both.groupBy("u").agg(F.min("w").alias("w0")).select("u", F.least("u", "w0").alias("low"))
        large = both.where("w > u").join(low, "u").select(F.col("w").alias("v"), F.col("low").alias("m")).distinct()
        least = large.groupBy("v").agg(F.min("m").alias("root"))
        small = large.join(least, "v")
        stars = settle(small.select("v", "root").union(small.select("m", "root")).where("v != root")
                       .distinct().toDF("v", "m"), "stars")


def group_labels(rows: DataFrame, best: str) -> DataFrame:
    """(fp, best) per distinct fingerprint: the smallest ``best`` over its whole near-duplicate group.

    ``rows`` has ``fp`` and an orderable column ``best``; nulls in it are ignored.
    """
    fps = settle(rows.groupBy("fp").agg(F.min(best).alias(best)), "fps")
    label = components(links(fps.select("fp"))).withColumnsRenamed({"node": "fp"})
    rooted = fps.join(label, "fp", "left").select("fp", best, F.coalesce("root", "fp").alias("root"))
    top = rooted.groupBy("root").agg(F.min(best).alias("top"))
    return rooted.join(top, "root").select("fp", F.col("top").alias(best))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (smallest doc_id of the group) of every row."""
    slim = docs.select("doc_id", "text")
    rows = settle(with_fingerprint(slim, "fp").select("doc_id", "fp"), "fingerprints")
    label = group_labels(rows, "doc_id").withColumnsRenamed({"doc_id": "component_id"})
    return rows.join(label, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one row of each near-duplicate group: the smallest doc_id (null last).

    Rows that tie in doc_id are told apart by a row number fixed when the table is written. The rows that go are found on
    fingerprints and row numbers alone; the stored texts are then read once against that list, by whatever join its size allows.
    """
    names = docs.columns
    fp, row = unused(names, "__fp"), unused(names, "__row")
    numbered = settle(with_fingerprint(docs, fp).withColumn(row, F.monotonically_increasing_id()), "documents")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    slim = numbered.select(F.col(fp).alias("fp"), rank.alias("best"))
    best = group_labels(slim, "best").select("fp", F.col("best.row").alias("kept"))
    gone = slim.join(best, "fp").where(F.col("best.row") != F.col("kept")).select(F.col("best.row").alias(row))
    return numbered.join(settle(gone, "gone"), row, "left_anti").select(*names)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
