"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, lower-cased. A benchmark item and a document are compared
when they share a seed: ``MIN_TILE`` tokens in a row, found by Karp-Rabin hashes and confirmed on
the tokens. Seeds on one diagonal join into maximal common runs; tiling then marks, again and
again, the longest run whose tokens are still unmarked on both sides (a run that was partly
covered meanwhile returns to the queue as its uncovered rests). The share of an item's tokens
under tiles is its coverage, whatever the order of the tiles in the document, so reordered
passages count in full. A document is contaminated by an item at coverage ``MIN_COVERAGE`` or more.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_ITEMS`` items, each
block is broadcast (its size is bounded by that count and by ``BLOCK_CHARS``), and all
documents are scanned against it. Where there are several blocks, the result of one is written and its broadcast
released before the next is read, so the driver and the workers hold one block at a time. Documents are never shuffled,
joined or paired with each other. An item longer than ``BLOCK_CHARS`` forms a block of its own.

A document's work is linear in its text plus its seed matches. Those are joined into runs in slices of ``SLICE`` matches,
so a text that repeats a seed of an item over and over takes memory for its runs only, and tiling ends as soon as the item has no
unmarked stretch of a tile's length left.

Edge cases: null and empty texts match nothing; an item with fewer than ``MIN_TILE`` tokens is
tiled with tiles of its own length; an item without tokens matches nothing; repeated items and
rows are reported each for themselves; null ids are carried; an empty benchmark or document table
gives no matches.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from seawake.llm.common import map_columns, prepare, settle, strings, table

MIN_TILE = 4
MIN_COVERAGE = 0.5
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000
SLICE = 1 << 20          # seed matches joined at a time
SEED = 5

_TOKEN = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)     # odd multiplier of the rolling hash, modulo 2^64

MATCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("coverage", T.DoubleType()), T.StructField("n_tiles", T.LongType()),
    T.StructField("longest_tile", T.LongType()), T.StructField("item_tokens", T.LongType())])


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def karp_rabin(ids: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of every window of ``width`` token numbers."""
    n = len(ids) - width + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        h = h * _BASE + ids[k:k + n]
    return h


def tile(runs: list[tuple[int, int, int]], item_len: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, length) out of maximal common runs.

    The longest unmarked run is marked first; ties go to the earliest in the item, then in the document.
    """
    heap = [(-n, p, d) for p, d, n in runs]
    heapq.heapify(heap)
    item_marked, doc_marked = bytearray(item_len), set()
    tiles = []
    room = bytes(least)
    while heap and room in item_marked:
        n, p, d = heapq.heappop(heap)
        free = [not item_marked[p + i] and d + i not in doc_marked for i in range(-n)]
        if all(free):
            tiles.append((p, d, -n))
            item_marked[p:p - n] = b"\x01" * -n
            doc_marked.update(range(d, d - n))
            continue
        start = None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                if i - start >= least:
                    heapq.heappush(heap, (start - i, p + start, d + start))
                start = None
    return tiles


def join_seeds(p: np.ndarray, d: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Maximal runs (item start, document start, length) of seeds of ``width`` tokens on equal diagonals."""
    order = np.lexsort((p, d - p))
    p, d = p[order], d[order]
    cut = np.flatnonzero((np.diff(d - p) != 0) | (np.diff(p) != 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(p)]]) - 1
    return list(zip(p[first].tolist(), d[first].tolist(), (p[last] - p[first] + width).tolist(), strict=True))


class Runs:
    """Runs of the items a document shares seeds with, from slices of matches in the order of the document."""

    def __init__(self, width: int):
        self.width = width
        self.done: dict[int, list[tuple[int, int, int]]] = {}
        self.open: dict[tuple[int, int], list[int]] = {}       # (item, diagonal) -> [item start, document start, length] up to the slice's end

    def add(self, item: int, p: np.ndarray, d: np.ndarray, border: int) -> None:
        """Matches of one slice; ``border`` is the first document position of the next one."""
        runs = self.done.setdefault(item, [])
        for start, doc, n in join_seeds(p, d, self.width):
            key = (item, doc - start)
            before = self.open.get(key)
            if before and before[1] + before[2] - self.width + 1 == doc:      # goes on where the last slice stopped
                before[2] += n
                before[2] -= self.width - 1
            else:
                if before:
                    runs.append(tuple(before))
                self.open[key] = before = [start, doc, n]
            if before[1] + before[2] - self.width + 1 < border:               # ended inside the slice
                runs.append(tuple(self.open.pop(key)))

    def all(self) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        for (item, _), run in self.open.items():
            self.done[item].append(tuple(run))
        yield from sorted(self.done.items())


class Block:
    """One block of benchmark items with the seeds of each tile width."""

    def __init__(self, items: list[tuple[int | None, str]], least: int = MIN_TILE):
        self.least = least
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)]
            if ids:
                self.items.append((item_id, np.array(ids, np.uint64)))
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in sorted({min(least, len(ids)) for _, ids in self.items}):
            mine = [(k, karp_rabin(ids, width)) for k, (_, ids) in enumerate(self.items)
                    if min(least, len(ids)) == width]
            h = np.concatenate([x for _, x in mine])
            owner = np.concatenate([np.full(len(x), k, np.int64) for k, x in mine])
            place = np.concatenate([np.arange(len(x), dtype=np.int64) for _, x in mine])
            order = np.argsort(h, kind="stable")
            self.seeds[width] = h[order], owner[order], place[order]

    def compare(self, text: str) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(item number, tiles) of every item that shares a seed with ``text``."""
        known = self.vocabulary.get
        ids = np.array([known(w, 0) for w in tokens(text)], np.uint64)
        if not ids.any():
            return
        zeros = np.concatenate([[0], np.cumsum(ids == 0)])
        for width, (hashes, owner, place) in self.seeds.items():
            n = len(ids) - width + 1
            if n <= 0:
                continue
            at = np.flatnonzero(zeros[width:] == zeros[:n])     # windows of benchmark words only
            if not len(at):
                continue
            h = karp_rabin(ids, width)[at]
            lo = np.searchsorted(hashes, h, "left")
            count = np.searchsorted(hashes, h, "right") - lo
            hit = count > 0
            at, lo, count = at[hit], lo[hit], count[hit]
            if not len(at):
                continue
            ends, runs, a = np.cumsum(count), Runs(width), 0
            while a < len(at):                                  # slices of whole document positions
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE, "right")))
                many = count[a:b]
                until = np.cumsum(many)
                slot = np.repeat(lo[a:b] - (until - many), many) + np.arange(until[-1])
                self._slice(runs, ids, width, np.repeat(at[a:b], many), owner[slot], place[slot],
                            int(at[b]) if b < len(at) else len(ids) + 1)
                a = b
            for k, found in runs.all():
                if found:
                    yield k, tile(found, len(self.items[k][1]), width)

    def _slice(self, runs: Runs, ids, width, d, owner, p, border) -> None:
        order = np.argsort(owner, kind="stable")
        d, owner, p = d[order], owner[order], p[order]
        edges = np.flatnonzero(np.diff(owner)) + 1
        for group in np.split(np.arange(len(owner)), edges):
            k = int(owner[group[0]])
            item = self.items[k][1]
            gp, gd = p[group], d[group]
            same = np.ones(len(group), bool)
            for i in range(width):                              # equal hashes: compare the tokens
                same &= item[gp + i] == ids[gd + i]
            if same.any():
                runs.add(k, gp[same], gd[same], border)

    def matches(self, text: str, threshold: float) -> list[tuple[int | None, float, int, int, int]]:
        """(item_id, coverage, tiles, longest tile, item tokens) of the items ``text`` contains."""
        found = []
        for k, tiles in self.compare(text):
            item_id, item = self.items[k]
            covered = sum(n for _, _, n in tiles)
            if covered >= threshold * len(item):
                found.append((item_id, covered / len(item), len(tiles), max(n for _, _, n in tiles), len(item)))
        return found


def blocks(benchmark: DataFrame) -> tuple[int, Iterator[Block]]:
    """How many blocks the benchmark may have, and the blocks; one at a time comes to the driver."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = F.length("text")
    # random slices (equal items fall apart), each cut along running totals of items and characters
    total = rows.agg(F.count("*"), F.sum(size)).first()
    slices = max(1, -(-total[0] // BLOCK_ITEMS), -(-(total[1] or 0) // BLOCK_CHARS))
    if slices == 1:
        return 1, iter([Block([tuple(r) for r in rows.collect()])])
    dealt = settle(rows.withColumn("slice", F.floor(F.rand(SEED) * slices)).withColumn("row", F.monotonically_increasing_id()), "benchmark")
    by = W.partitionBy("slice").orderBy("row").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = settle(dealt.withColumn("part", F.greatest(F.floor(F.count("*").over(by) / BLOCK_ITEMS),
                                                     F.floor(F.sum(size).over(by) / BLOCK_CHARS))), "benchmark-blocks")

    def each() -> Iterator[Block]:
        for s in range(slices):
            one = cut.where(F.col("slice") == s)
            last = one.agg(F.max("part")).first()[0]
            for part in range(0 if last is None else last + 1):
                got = one.where(F.col("part") == part).select("item_id", "text").collect()
                if got:
                    yield Block([tuple(r) for r in got])

    return slices, each()


def contaminations(docs: DataFrame, benchmark: DataFrame, threshold: float = MIN_COVERAGE) -> DataFrame:
    """One row per document and benchmark item it contains: coverage, tiles, longest tile."""
    spark = prepare(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    many, each = blocks(benchmark)
    out = spark.createDataFrame([], MATCH) if many > 1 else None
    for block in each:
        shared = spark.sparkContext.broadcast(block)

        def run(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            rows = [(i, *m) for i, t in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True)
                    for m in shared.value.matches(t, threshold)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(MATCH)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=MATCH.names)

        found = map_columns(slim, run, MATCH)
        if out is None:
            return found
        out = out.unionAll(settle(found, "contaminations"))
        shared.unpersist()
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = MIN_COVERAGE, least: int = MIN_TILE) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item of ``least`` or more tokens; nothing is shuffled.

    Shorter items are words that clean documents hold too; ``contaminations`` reports them all the same.
    """
    spark = prepare(docs.sparkSession)
    at = docs.columns.index("text")
    many, each = blocks(benchmark)
    for block in each:
        shared = spark.sparkContext.broadcast(block)

        def run(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = [all(m[-1] < least for m in shared.value.matches(t, threshold)) for t in strings(b.column(at))]
            return b.filter(pa.array(clean, pa.bool_()))

        docs = map_columns(docs, run, docs.schema)
        if many > 1:
            docs = settle(docs, "decontaminated")
            shared.unpersist()
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
