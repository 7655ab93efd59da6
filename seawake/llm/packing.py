"""Sequence packing: first-fit decreasing on a tournament tree, in randomised groups.

A document is its token ids plus the end id. It is cut at multiples of ``LENGTH``: full pieces are
sequences of their own, the remaining tails are packed. Pieces fall into random groups with the tails of about
``GROUP_DOCS`` documents each; each group is packed on its own by first-fit decreasing. A tournament tree
over the bins keeps in every inner node the largest free capacity below it, so the first bin that
fits is found, and its capacity updated, in logarithmic time.

Groups are random and balanced (never keyed by a document's properties), so neither copies nor a
hot source can overfill one. The ids travel with their pieces through one shuffle, two bytes each where the vocabulary
allows; a task holds the tails of one group at a time, full pieces pass by. The sequences (``LENGTH`` ids as one little-endian
unsigned 32-bit binary value, padded with ``PAD_ID``, and the pieces they hold) are written as a table; placements and
checksums are read back from it.

Token ids are those of the ``tokenizers`` library. Common text is encoded with the same
vocabulary and merges through the faster byte-pair encoder of ``tiktoken`` (equal ids, see the
tests); texts with rare characters or very long unbroken runs go to ``tokenizers`` itself.

Edge cases: null text is empty and holds the end id only; repeated rows and null ids are packed
as rows of their own; a document longer than a sequence spans several; an empty table gives no
sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import map_columns, settle, strings, table

LENGTH = 2048
END_ID = 1
PAD_ID = 0
GROUP_DOCS = 4096
SEED = 11
VOCABULARY = "byte_bpe_50k"

# Characters on which both encoders' splitting rules are known to agree, and the longest run without a blank.
_RARE = re.compile("[^\n\t -~¡-ɏ–—‘’“”…€]")
_SPECIAL = "<|endoftext|>"
_RUN = 1000
_LONG = re.compile(rf"\S{{{_RUN}}}")


def _long_run(text: str) -> bool:
    """Whether ``_RUN`` characters without white space follow each other.

    Such a run covers a whole aligned block of half its length, so texts with a blank in every block need no search.
    """
    half = _RUN // 2
    return (any(" " not in text[i:i + half] for i in range(0, len(text) - half + 1, half))
            and _LONG.search(text) is not None)


def rare(text: str) -> bool:
    """Whether only the tokenizer itself may encode ``text``."""
    return _RARE.search(text) is not None or _SPECIAL in text or _long_run(text)


class Encoder:
    """Both encoders of a vocabulary; the exact one, which few texts need, is loaded with the first of them."""

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers as files
        import tiktoken

        self.file = files.path(f"{name}.json")
        with open(files.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def ids(self, text: str) -> np.ndarray:
        """Token ids of a whole text, without the end id."""
        if rare(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


@cache
def encoder(name: str = VOCABULARY) -> Encoder:
    return Encoder(name)


PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                       T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                       T.StructField("ids", T.BinaryType())])


def id_type(vocabulary: str) -> str:
    """The narrowest unsigned type that holds all ids."""
    return "<u2" if encoder(vocabulary).exact.get_vocab_size() <= 1 << 16 else "<u4"


def token_pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """The ids of every row (end id included) in pieces of ``length``."""

    kind = id_type(vocabulary)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc, rows = encoder(vocabulary), []
        for doc_id, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
            ids = np.append(enc.ids(text), END_ID).astype(kind)
            rows += [(doc_id, len(ids), i, min(length, len(ids) - i), ids[i:i + length].tobytes())
                     for i in range(0, len(ids), length)]
        kinds = [*[pa.int64()] * 4, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=PIECES.names)

    return map_columns(docs.select("doc_id", "text"), run, PIECES)


class BinTree:
    """Tournament tree over at most ``n`` bins of ``capacity``; every node holds the best capacity below."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin that has room; (bin, free capacity it had)."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        had = best[node]
        best[node] = had - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            top = max(best[2 * node], best[2 * node + 1])
            if best[node] == top:
                break
            best[node] = top
        return bin_, had


def first_fit_decreasing(sizes: list[int], capacity: int = LENGTH) -> list[tuple[int, int]]:
    """(bin, offset) of every size; larger ones first, ties in the given order."""
    tree = BinTree(len(sizes), capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b, had = tree.place(sizes[i])
        out[i] = b, capacity - had
    return out


LAID_ROWS = 256              # sequences of one Arrow batch: 2 MB of ids
PLACED = ("doc_id", "start", "length", "doc_tokens", "offset")
SEQUENCES = T.StructType([
    T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("pieces", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in PLACED])))])

Piece = tuple[int | None, int, int, int, bytes]          # doc_id, start, length, doc_tokens, ids


def _laid(first: int, rows: list[Piece], places: list[tuple[int, int]], length: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Sequences numbered from ``first``, of pieces laid at (bin, offset)."""
    bins: list[list[tuple[Piece, int]]] = [[] for _ in range(max((b for b, _ in places), default=-1) + 1)]
    for row, (b, offset) in zip(rows, places, strict=True):
        bins[b].append((row, offset))
    for lo in range(0, len(bins), LAID_ROWS):
        part = [sorted(b, key=lambda p: p[1]) for b in bins[lo:lo + LAID_ROWS]]
        ids = np.full((len(part), length), PAD_ID, "<u4")
        for line, held in zip(ids, part, strict=True):
            for row, offset in held:
                line[offset:offset + row[2]] = np.frombuffer(row[4], kind)
        columns = zip(*[(*row[:4], offset) for held in part for row, offset in held], strict=True)
        pieces = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(PLACED))
        ends = np.cumsum([0, *map(len, part)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(first + lo, first + lo + len(part))),
             pa.array([line.tobytes() for line in ids], pa.binary()),
             pa.ListArray.from_arrays(ends, pieces)], names=SEQUENCES.names)


def sequences(docs: DataFrame, length: int = LENGTH, group_docs: int = GROUP_DOCS, seed: int = SEED,
              vocabulary: str = VOCABULARY) -> DataFrame:
    """The packed sequences, written as a table: sequence_id, ``length`` ids (binary), the pieces they hold.

    A sequence id is the group number times 2^40 plus the sequence's number in its group.
    """
    groups = max(1, -(-docs.count() // group_docs))
    kind = id_type(vocabulary)                       # known before: the packing tasks load no vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first = None, 0
        tails: list[Piece] = []
        full: list[Piece] = []

        def laid() -> Iterator[pa.RecordBatch]:
            """Tails come before the full pieces of their group, so one of both lists is empty."""
            nonlocal first, tails, full
            places = first_fit_decreasing([t[2] for t in tails], length) if tails else [(i, 0) for i in range(len(full))]
            yield from _laid(first, tails or full, places, length, kind)
            first += max((b for b, _ in places), default=-1) + 1
            tails, full = [], []

        for b in batches:
            for g, *row in zip(*[b.column(n).to_pylist() for n in ("group", *PLACED[:4], "ids")], strict=True):
                if g != group:
                    yield from laid()
                    group, first = g, g << 40
                if row[2] < length:
                    tails.append(tuple(row))
                    continue
                if tails or len(full) == LAID_ROWS:
                    yield from laid()
                full.append(tuple(row))
        yield from laid()

    # one partition a group: few groups hashed into the session's partitions would meet in some of them
    grouped = (token_pieces(docs, length, vocabulary).withColumn("group", F.floor(F.rand(seed) * groups))
               .repartitionById(groups, F.col("group").cast("int")).sortWithinPartitions("group", F.col("length") == length))
    return settle(grouped.mapInArrow(run, SEQUENCES), "packed-sequences")


PACKED = T.StructType([T.StructField(n, T.LongType()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def placements(packed: DataFrame) -> DataFrame:
    """One row per piece of the packed sequences, with the checksum of its ids there."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        raw = [memoryview(x.as_buffer()) for x in b.column(1)]
        line = np.repeat(np.arange(b.num_rows), b.column(2).value_lengths().to_numpy())
        out = dict(zip(PLACED, b.column(2).flatten().flatten(), strict=True))
        at = 4 * out["offset"].to_numpy()
        end = at + 4 * out["length"].to_numpy()
        out["ids_crc32"] = pa.array([zlib.crc32(raw[k][i:j]) for k, i, j in
                                     zip(line.tolist(), at.tolist(), end.tolist(), strict=True)], pa.int64())
        out["sequence_id"] = b.column(0).take(pa.array(line))
        return pa.RecordBatch.from_arrays([out[n] for n in PACKED.names], names=PACKED.names)

    return map_columns(packed, run, PACKED)


def pack(docs: DataFrame, length: int = LENGTH, group_docs: int = GROUP_DOCS, seed: int = SEED,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return placements(sequences(docs, length, group_docs, seed, vocabulary))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
