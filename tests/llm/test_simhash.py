import itertools
import random

import pytest
import xxhash

from seawake.llm import simhash
from tests.llm.conftest import frame, sample_texts


def slow_fingerprint(text):
    """Bit by bit, straight from the definition."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps):
    """Smallest member of the component of every fingerprint, all pairs compared."""
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(sorted(set(fps)), 2):
        if (a ^ b).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def unsigned(n):
    return n & ((1 << 64) - 1)


def test_fingerprint_equals_definition():
    for t in sample_texts():
        if t is None or len(t) < 20_000:
            assert unsigned(simhash.fingerprint(t)) == slow_fingerprint(t)


def signed(n):
    return n - (1 << 64) if n >> 63 else n


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(12):
            g = f
            for _ in range(rng.randint(1, 3)):
                g ^= 1 << rng.randrange(64)
            fps.add(g)
            f = g if rng.random() < 0.3 else f
    fps |= {0, (1 << 64) - 1, 1 << 63, 3, 7}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {frozenset((unsigned(r.a), unsigned(r.b))) for r in simhash.links(df).collect()}
    want = {frozenset(p) for p in itertools.combinations(fps, 2) if (p[0] ^ p[1]).bit_count() <= 2}
    assert got == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 200), (200, 250)]
    df = spark.createDataFrame([(min(e), max(e)) for e in edges], "a long, b long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 250: 200, 300: 200}


def test_groups_equal_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fp = [slow_fingerprint(t) if t is None or len(t) < 20_000 else unsigned(simhash.fingerprint(t)) for _, t in rows]
    root = slow_groups(fp)
    least = {}
    for (i, _), f in zip(rows, fp, strict=True):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fp, strict=True)), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == want


def test_keep_one_keeps_the_smallest_id_of_each_group(docs):
    want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)      # one row each, repeated rows included


def test_null_ids_and_empty_tables(spark, no_docs):
    only = frame(spark, ["same text here", "same text here"], [None, None])
    assert [r.component_id for r in simhash.near_duplicates(only).collect()] == [None, None]
    assert simhash.keep_one(only).count() == 1
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_kept_rows_keep_columns_of_any_name(spark):
    texts = ["one two three four", "one two three four", "quite another text here", None]
    rows = [(i, t, 77, -1, f"x{i}") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, __row long, __FP int, best string")
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    got = sorted((r.doc_id, r.text, r["__row"], r["__FP"], r.best) for r in kept.collect())
    assert got == [(i, t, 77, -1, f"x{i}") for i, t in enumerate(texts) if i != 1]


def test_texts_are_not_forced_through_a_hash_join(spark, docs):
    plan = simhash.keep_one(docs)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" not in plan and "hint" not in plan.lower()
