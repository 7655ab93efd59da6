"""Ranked lexical search by the Best Position Algorithm on impact lists.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased. With N documents
that hold a term, L terms in all of them, n terms in one, df documents with a term and tf its occurrences in one,

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))      m = 100 - 25 + (25 n N div L)
    score = sum of  w ((1000000000 tf) div (1000 tf + 12 m))  over the query's terms, repeats included

in 64-bit integers but for the logarithm. A query gets its ``k`` documents of highest score above zero, equal scores by
rising doc_id.

**Lists.** Documents are dealt into shards of at most ``SHARD_DOCS`` rows. In a shard every term has its impact list: the documents
that hold it by falling impact (the second factor above), and for every document the places it has in the lists.

**Best positions.** A query reads its lists in parallel from the top. A document met for the first time is scored at once by
direct access to all lists, and its places there are marked as seen. The best position of a list is the end of the seen places
that follow each other without a gap from its top, however they were seen; it is never above the last place read, and often far below. A document
not met yet stands behind the best position of each list that holds it, so the sum of the weighted impacts just behind the best positions
(zero for a list seen to its end) bounds its score. The query stops when that bound is strictly below its k-th
score so far, so documents that tie with the k-th are all met. The k-th score of earlier shards of the same task holds on as
a floor. Tasks keep ``k`` rows a query, and a window ranks what the tasks kept.

**Scale.** Statistics are sums over all documents. Queries are read in blocks of about ``BLOCK_TERMS`` terms; the terms and weights of one block
are broadcast, its postings are written (only terms of the block), and its results too before the next block is read, so
nothing that grows with the documents or the queries is held on one machine. No posting is shuffled: a frequent term is
a list in every shard, never a key.

Edge cases: null and empty texts have no terms; a query without terms, or without matches, has no rows; repeated queries and
documents count and rank each for themselves; a null doc_id ranks last among equal scores; an empty table gives an empty
result; other columns of the tables are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from seawake.llm.common import map_columns, prepare, settle, table

K = 20
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 21
BLOCK_TERMS = 500_000
FIRST_READ, MOST_READ = 16, 1024          # places read of every list at a time, doubling

# UTF-8 bytes: term bytes as they are (A-Z lower-cased), all others to a blank.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text in order."""
    return text.translate(_TERM_BYTES).split() if text else []


ITEMS = T.StructType([T.StructField("iid", T.LongType()), T.StructField("item_id", T.LongType()),
                      T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("times", T.ArrayType(T.LongType()))])
POSTINGS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                         T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])
HITS = T.StructType([T.StructField("iid", T.LongType()), T.StructField("item_id", T.LongType()),
                     T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def _lists(rows: list[Counter], kind: pa.DataType, counts: pa.DataType) -> tuple[pa.ListArray, pa.ListArray]:
    ends = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
    return (pa.ListArray.from_arrays(ends, pa.array([t for r in rows for t in r], kind)),
            pa.ListArray.from_arrays(ends, pa.array([n for r in rows for n in r.values()], counts)))


def items_of(queries: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The queries, numbered, with their different terms and how often each occurs; written."""
    given = queries.select(F.monotonically_increasing_id().alias("iid"), F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("binary"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [Counter(terms(t)) for t in b.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *_lists(found, pa.binary(), pa.int64())], names=ITEMS.names)

    return settle(map_columns(given, run, ITEMS), "query-terms")


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per document: its number of terms, and number and frequency of each term in ``numbers``; written."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        number, sizes, found = shared.value.get, [], []
        for t in b.column(1).to_pylist():
            words = terms(t)
            sizes.append(len(words))
            found.append(Counter(x for x in map(number, words) if x is not None))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), *_lists(found, pa.int32(), pa.int32())],
                                          names=POSTINGS.names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = settle(map_columns(slim, run, POSTINGS), "postings")
    shared.unpersist()
    return out


class Query:
    """One query: its different terms (numbers of the block) and their weights times occurrences."""

    def __init__(self, iid: int, item_id: int | None, numbers: list[int], weights: list[int]):
        self.iid, self.item_id = iid, item_id
        self.numbers, self.weights = np.array(numbers, np.int64), np.array(weights, np.int64)


class Shard:
    """Impact lists of some documents, and every document's places in them."""

    def __init__(self, doc_ids: list[int | None], sizes: np.ndarray, ends: np.ndarray, numbers: np.ndarray, tfs: np.ndarray,
                 n_docs: int, n_terms: int, vocabulary: int):
        self.doc_ids, self.ends = doc_ids, ends
        m = 75 + 25 * sizes * n_docs // max(n_terms, 1)
        owner = np.repeat(np.arange(len(sizes)), np.diff(ends))
        self.impact = 1_000_000_000 * tfs // (1000 * tfs + 12 * m[owner])
        order = np.lexsort((-self.impact, numbers))
        self.numbers, self.owner = numbers, owner
        self.list_doc, self.list_impact = owner[order], self.impact[order]
        self.place = np.empty(len(order), np.int64)              # of a posting in the lists
        self.place[order] = np.arange(len(order))
        self.start = np.searchsorted(numbers[order], np.arange(vocabulary + 1))
        # work space that every query leaves as it found it
        self.seen, self.met = np.zeros(len(order), bool), np.zeros(len(sizes), bool)
        self.weight = np.zeros(vocabulary, np.int64)

    def _direct(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of ``docs`` by direct access, and the places of their postings under the query's terms."""
        lo, n = self.ends[docs], self.ends[docs + 1] - self.ends[docs]
        last = np.cumsum(n)
        at = np.repeat(lo - (last - n), n) + np.arange(last[-1])
        weight = self.weight[self.numbers[at]]
        worth = np.concatenate([[0], np.cumsum(weight * self.impact[at])])
        return worth[last] - worth[last - n], self.place[at[weight > 0]]

    def best(self, query: Query, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) of all documents of the shard that may be among the ``k`` best; ``floor`` is a k-th score known."""
        first, end = self.start[query.numbers], self.start[query.numbers + 1]
        used = (query.weights > 0) & (end > first)
        first, end, weights = first[used], end[used], query.weights[used]
        if not len(first):
            return []
        self.weight[query.numbers[used]] = weights
        best, at, step = first.copy(), first.copy(), FIRST_READ
        scores, docs, marked = [], [], []
        top = np.zeros(0, np.int64)                              # the k best scores so far
        while True:
            read = np.concatenate([self.list_doc[a:min(a + step, e)] for a, e in zip(at.tolist(), end.tolist(), strict=True) if a < e])
            new = np.unique(read[~self.met[read]])
            if len(new):
                got, places = self._direct(new)
                self.met[new] = self.seen[places] = True
                scores.append(got)
                docs.append(new)
                marked.append(places)
                top = np.concatenate([top, got])
                top = np.partition(top, len(top) - k)[-k:] if len(top) > k else top
            at = np.minimum(at + step, end)
            bound = 0
            for i, (b, e) in enumerate(zip(best.tolist(), end.tolist(), strict=True)):
                while b < e:                                     # to the first place not seen
                    gap = self.seen[b:min(b + 4 * step, e)]
                    hole = int(gap.argmin())
                    if not gap[hole]:
                        b += hole
                        bound += int(weights[i]) * int(self.list_impact[b])
                        break
                    b += len(gap)
                best[i] = b
            at = np.maximum(at, best)                            # what is seen need not be read
            kth = max(floor, int(top.min()) if len(top) >= k else 0)
            if bound < kth or bound == 0:
                break
            step = min(2 * step, MOST_READ)
        for places in marked:
            self.seen[places] = False
        for d in docs:
            self.met[d] = False
        self.weight[query.numbers] = 0
        all_scores, all_docs = np.concatenate(scores), np.concatenate(docs)
        keep = all_scores >= max(kth, 1)
        return list(zip(all_scores[keep].tolist(), all_docs[keep].tolist(), strict=True))


def _rank(hit: tuple[int, int | None]) -> tuple:
    return -hit[0], hit[1] is None, hit[1] or 0


def shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, vocabulary: int) -> Iterator[Shard]:
    """Postings in shards of at most ``SHARD_DOCS`` documents and, but for the last one added, ``SHARD_POSTINGS`` postings."""
    held: list[pa.RecordBatch] = []

    def made() -> Shard:
        sizes = np.concatenate([b.column(1).to_numpy() for b in held])
        lengths = np.concatenate([b.column(2).value_lengths().to_numpy() for b in held])
        numbers, tfs = (np.concatenate([b.column(c).flatten().to_numpy() for b in held]).astype(np.int64) for c in (2, 3))
        return Shard([i for b in held for i in b.column(0).to_pylist()], sizes, np.concatenate([[0], np.cumsum(lengths)]),
                     numbers, tfs, n_docs, n_terms, vocabulary)

    docs = size = 0
    for b in batches:
        if held and (docs + b.num_rows > SHARD_DOCS or size > SHARD_POSTINGS):
            yield made()
            held, docs, size = [], 0, 0
        if b.num_rows:
            held.append(b)
            docs += b.num_rows
            size += len(b.column(2).flatten())
    if held:
        yield made()


def _blocks(items: DataFrame) -> Iterator[list]:
    """The queries in blocks of about ``BLOCK_TERMS`` terms; one block at a time comes to the driver."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_TERMS))
    for b in range(n):
        yield items.where(F.pmod(F.xxhash64("iid"), F.lit(n)) == b).collect()


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(iid, item_id, rank, doc_id, score): the ``k`` best documents of every row of ``queries`` (item_id, text)."""
    spark = prepare(docs.sparkSession)
    parts = []
    for block in _blocks(items_of(queries)):
        numbers: dict[bytes, int] = {}
        for q in block:
            for t in q.terms:
                numbers.setdefault(bytes(t), len(numbers))
        lists = postings(docs, numbers)
        n_docs, n_terms = lists.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(lists.select(F.explode("terms").alias("t")).groupBy("t").count().collect())      # one row a term of the block
        asked = [Query(q.iid, q.item_id, [numbers[bytes(t)] for t in q.terms],
                       [n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(numbers[bytes(t)], 0) + 1)))
                        for t, n in zip(q.terms, q.times, strict=True)]) for q in block]
        parts.append(_searched(spark, lists, asked, k, n_docs, n_terms, len(numbers)))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.union(p)
    order = W.partitionBy("iid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("iid", "item_id", "rank", "doc_id", "score")


def _searched(spark: SparkSession, lists: DataFrame, asked: list[Query], k: int, n_docs: int, n_terms: int, vocabulary: int) -> DataFrame:
    """The best hits of every task for the queries of one block; written."""
    shared = spark.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, kept = shared.value, {}
        for shard in shards(batches, n_docs, n_terms, vocabulary):
            for q in queries:
                old = kept.get(q.iid, [])
                found = shard.best(q, k, old[-1][0] if len(old) == k else 0)
                if found:
                    kept[q.iid] = sorted(old + [(s, shard.doc_ids[d]) for s, d in found], key=_rank)[:k]
        rows = [(q.iid, q.item_id, doc, score) for q in queries for score, doc in kept.get(q.iid, [])]
        for lo in range(0, len(rows), 100_000):
            columns = zip(*rows[lo:lo + 100_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=HITS.names)

    out = settle(lists.mapInArrow(run, HITS), "hits")
    shared.unpersist()
    return out


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("iid")


_SQL_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS ts FROM documents),
s AS (SELECT count(*) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d WHERE len(ts) > 0),
i AS (SELECT row_number() OVER () AS iid, item_id, {_SQL_TERMS} AS ts FROM benchmark),
q AS (SELECT iid, item_id, t, count(*) AS times FROM (SELECT iid, item_id, unnest(ts) AS t FROM i) GROUP BY ALL),
p AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
scored AS (
  SELECT iid, item_id, doc_id, r,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN p USING (t) JOIN w USING (t), s GROUP BY iid, item_id, doc_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {K}
"""
