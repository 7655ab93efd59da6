import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from seawake.llm import common, search
from seawake.llm.common import prepare
from tests._compare import compare, duck
from tests._paths import SF_MID, SF_SMALL
from tests.llm.conftest import frame

QUERIES = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                        T.StructField("iid", T.StringType()), T.StructField("score", T.IntegerType())])


def asked(spark, texts, ids=None):
    return prepare(spark).createDataFrame([(i, t, "x", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], QUERIES)


def slow_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow_search(docs, queries, k):
    """Every score of every document, from the definition."""
    counted = [(i, Counter(slow_terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in queries:
        scores = []
        for i, c in counted:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in slow_terms(text) if t in c)
            scores += [(-s, i is None, i or 0, i)] if s > 0 else []
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def sample(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "The", "ÉTÉ", "été", "a1", "x", "中文", "😀", "straße"] + [f"w{i}" for i in range(60)]
    weights = [30, 20, 10] + [3] * 7 + [1] * 60
    text = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))) for _ in range(n)]
    text += [text[3]] * 25 + [None, "", "_-\x7f[]", "the\x00of`the{of", "the " * 5000 + "w1"]
    ids = [*range(len(text) - 3), None, None, 4]
    queries = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) for _ in range(12)]
    return list(zip(ids, text, strict=True)), [*queries, None, "", "unknownterm", "the the the of", text[3], queries[0]]


@pytest.mark.parametrize("limits", [None, (7, 40, 2)])
def test_search_equals_brute_force(spark, monkeypatch, limits):
    if limits:                                       # many shards and blocks
        for name, v in zip(("SHARD_DOCS", "BLOCK_TERMS", "FIRST_READ"), limits, strict=True):
            monkeypatch.setattr(search, name, v)
        monkeypatch.setattr(common, "BATCH_ROWS", 5)
    for seed, k in ((1, 20), (2, 3)):
        docs, queries = sample(seed)
        got = search.search(frame(spark, [t for _, t in docs], [i for i, _ in docs]), asked(spark, queries), k).collect()
        rows = [(r.item_id, r["rank"], r.doc_id, r.score) for r in got]
        assert sorted(rows, key=str) == slow_search(docs, list(enumerate(queries)), k)


def shard_of(impacts):
    """A shard with one list per row of ``impacts`` (documents as columns, 0: not in the list); impacts are set as given."""
    lists, docs = len(impacts), len(impacts[0])
    held = [[t for t in range(lists) if impacts[t][d]] for d in range(docs)]
    numbers = np.array([t for h in held for t in h], np.int64)
    ends = np.cumsum([0, *map(len, held)])
    shard = search.Shard(list(range(docs)), np.ones(docs, np.int64), ends, numbers, np.ones(len(numbers), np.int64), docs, docs, lists)
    shard.impact = np.array([impacts[t][d] for d, h in enumerate(held) for t in h], np.int64)
    order = np.lexsort((-shard.impact, numbers))
    shard.list_doc, shard.list_impact = shard.owner[order], shard.impact[order]
    shard.place[order] = np.arange(len(order))
    return shard


def test_best_positions_find_every_tie_and_stop_early(monkeypatch):
    rng = random.Random(5)
    met = []
    direct = search.Shard._direct
    monkeypatch.setattr(search.Shard, "_direct", lambda self, docs: met.append(len(docs)) or direct(self, docs))
    monkeypatch.setattr(search, "FIRST_READ", 1)
    monkeypatch.setattr(search, "MOST_READ", 1)
    for trial in range(60):
        lists, docs, k = rng.randint(1, 5), rng.randint(1, 120), rng.randint(1, 6)
        most = rng.choice([3, 1000])
        impacts = [[rng.randint(0, most) for _ in range(docs)] for _ in range(lists)]
        weights = [rng.randint(0, 4) for _ in range(lists)]
        shard, query = shard_of(impacts), search.Query(0, 0, list(range(lists)), weights)
        totals = [sum(w * row[d] for w, row in zip(weights, impacts, strict=True)) for d in range(docs)]
        want = sorted((s, d) for s, d in zip(totals, range(docs), strict=True) if s > 0)
        kth = sorted((s for s, _ in want), reverse=True)[k - 1] if len(want) >= k else 1
        for _ in range(2):                           # the work space is left clean
            assert sorted(shard.best(query, k, 0)) == [x for x in want if x[0] >= kth], trial
        floor = kth + rng.randint(0, 3)
        assert sorted(shard.best(query, k, floor)) == [x for x in want if x[0] >= floor]
    # the same few documents lead both lists: the lists are not read to their ends
    lead = [[1000 - d if d < 10 else 100 - d // 100 for d in range(5000)] for _ in range(2)]
    met.clear()
    assert sorted(shard_of(lead).best(search.Query(0, 0, [0, 1], [1, 1]), 5, 0)) == [(2 * (1000 - d), d) for d in range(4, -1, -1)]
    assert sum(met) < 20


def test_best_position_runs_ahead_of_the_last_place_read(monkeypatch):
    """Direct accesses fill a list's top while another list is read, so its bound falls without reading it."""
    monkeypatch.setattr(search, "FIRST_READ", 1)
    monkeypatch.setattr(search, "MOST_READ", 1)
    n = 400
    one = [n - d for d in range(n)]                  # both lists hold the documents in the same order, one in pairs swapped
    two = [n - (d ^ 1) for d in range(n)]
    shard = shard_of([one, two])
    query = search.Query(0, 0, [0, 1], [1, 1])
    assert len(shard.best(query, 2, 0)) == 2
    assert not shard.seen.any() and not shard.met.any() and not shard.weight.any()


def test_shards_are_cut_by_documents(monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 6)
    one = search.pa.RecordBatch.from_pylist([{"doc_id": 1, "n": 1, "terms": [0], "tfs": [1]}] * 3)
    assert [len(s.doc_ids) for s in search.shards(iter([one] * 5), 15, 15, 1)] == [6, 6, 3]


def test_terms_are_maximal_runs():
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("aZz09 _-.[`{\x7f\x80\x85éÉ 中😀\n\x00@/:") for _ in range(rng.randint(0, 20)))
        assert [t.decode() for t in search.terms(text.encode())] == slow_terms(text), repr(text)


def test_empty_tables_and_queries(spark, docs, no_docs):
    some = asked(spark, ["the of", None])
    assert search.search(no_docs, some).count() == 0
    assert search.search(docs, some.limit(0)).count() == 0
    assert search.search(docs, asked(spark, [None, "", "?!"])).count() == 0
    got = search.search(docs, asked(spark, ["the", "the"], [None, None])).collect()
    assert {r.item_id for r in got} == {None} and len({r.iid for r in got}) == 2


def test_query_equals_sql(spark):
    for sf in (SF_SMALL, SF_MID):
        assert compare(search.op12_search(spark, sf), duck(sf), search.ORACLE) > 0
