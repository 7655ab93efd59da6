import random
import time
import tracemalloc

from seawake.llm import decontam
from seawake.llm.decontam import Block, tile, tokens
from tests.llm.conftest import frame, words

BENCH = "item_id long, text string, coverage double"


def slow_tiles(item, doc, least):
    """Greedy string tiling by definition: scan all starts for the longest unmarked match, mark, repeat."""
    marked_i, marked_d, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (p + n < len(item) and d + n < len(doc) and item[p + n] == doc[d + n]
                       and p + n not in marked_i and d + n not in marked_d):
                    n += 1
                if n > best[2]:
                    best = (p, d, n)
        if best[2] < least:
            return out
        out.append(best)
        marked_i |= set(range(best[0], best[0] + best[2]))
        marked_d |= set(range(best[1], best[1] + best[2]))


def test_tiles_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        letters = "abcd"[:rng.randint(1, 4)]
        item = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        doc = [rng.choice(letters + "z") for _ in range(rng.randint(1, 30))]
        block = Block([(1, " ".join(item))], least=3)
        got = [t for _, t in block.compare(" ".join(doc))]
        least = min(3, len(item))
        assert (got[0] if got else []) == slow_tiles(item, doc, least)


def test_slices_change_nothing(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcd"[:rng.randint(1, 4)]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(3, 12)))) for i in range(6)]
    block = Block(items, least=3)
    whole = [{k: t for k, t in block.compare(x)} for x in texts]
    for size in (1, 2, 7, 50):
        monkeypatch.setattr(decontam, "SLICE", size)
        assert [{k: t for k, t in block.compare(x)} for x in texts] == whole


def test_contaminations_equal_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    pool = words(rng, 25)
    items = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(15)]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += [" ".join([rng.choice(texts), items[k % 15], rng.choice(pool)]) for k in range(30)] + [None, ""]
    want = set()
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            a, b = tokens(item), tokens(t or "")
            found = slow_tiles(a, b, min(decontam.MIN_TILE, len(a)))
            covered = sum(n for _, _, n in found)
            if covered >= decontam.MIN_COVERAGE * len(a):
                want.add((d, i, round(covered / len(a), 9), len(found), max(n for _, _, n in found), len(a)))
    bench = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(items)], BENCH)
    for block_items in (20_000, 4):
        monkeypatch.setattr(decontam, "BLOCK_ITEMS", block_items)
        rows = decontam.contaminations(frame(spark, texts), bench).collect()
        assert {(r.doc_id, r.item_id, round(r.coverage, 9), r.n_tiles, r.longest_tile, r.item_tokens) for r in rows} == want
        assert len(rows) == len(want) > 20
        kept = {r.doc_id for r in decontam.drop_contaminated(frame(spark, texts), bench, least=1).collect()}
        assert kept == set(range(len(texts))) - {d for d, *_ in want}


def test_equal_items_fall_into_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 10)
    bench = spark.createDataFrame([(1, "one and the same item", 0.0)] * 60, BENCH)
    sizes = [len(b.items) for b in decontam.blocks(bench)[1]]
    assert sum(sizes) == 60 and max(sizes) <= 10


def test_a_repeated_token_takes_little_memory_and_time():
    block = Block([(1, "a " * 300), (2, "a b " * 100 + "c")])
    tracemalloc.start()
    began = time.perf_counter()
    got = block.matches("a " * 20_000 + "b a " * 3000, 0.5)
    assert time.perf_counter() - began < 20
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert [(m[0], m[1]) for m in got] == [(1, 1.0), (2, 200 / 201)]


def test_partly_covered_run_returns_to_the_queue():
    assert tile([(0, 0, 6), (4, 10, 6)], 10, 3) == [(0, 0, 6), (6, 12, 4)]


def test_reordered_and_cased_passages_are_found(spark):
    rng = random.Random(8)
    item = words(rng, 40)
    other = words(rng, 40)
    filler = words(rng, 300)
    plain = " ".join([*filler[:50], *item, *filler[50:]])
    turned = " ".join([*filler[:20], *item[25:], *filler[20:60], *item[:12], "x", *item[12:25]])
    upper = " ".join(item).upper().replace(" ", ", ")
    part = " ".join([*filler, *item[:12]])
    docs = frame(spark, [plain, turned, upper, part, " ".join(filler), None, ""])
    bench = spark.createDataFrame([(7, " ".join(item), 0.1), (8, " ".join(other), 0.2), (9, None, 0.0), (None, "", 0.0)],
                                  BENCH)
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminations(docs, bench).collect()}
    assert set(got) == {(0, 7), (1, 7), (2, 7)}
    assert got[0, 7].coverage == 1.0 and got[0, 7].n_tiles == 1
    assert got[1, 7].coverage == 1.0 and got[1, 7].n_tiles == 3
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_blocks_hold_every_item_once(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, 6))) for i in range(50)]
    bench = spark.createDataFrame([(i, t, 0.0) for i, t in items], BENCH)
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 7)
    many, each = decontam.blocks(bench)
    got = sorted(i for b in each for i, _ in b.items)
    assert many == 8
    assert got == list(range(50))
    docs = frame(spark, [t for _, t in items])
    assert {(r.doc_id, r.item_id) for r in decontam.contaminations(docs, bench).collect()} == {(i, i) for i in range(50)}
    assert decontam.drop_contaminated(docs, bench).count() == 0


def test_short_items_ties_and_empty_tables(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "two words", 0.0), (1, "two words", 0.0)], BENCH)
    got = decontam.contaminations(frame(spark, ["so two words here", "two other words"], [4, 4]), bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(4, 1), (4, 1)]
    kept = decontam.drop_contaminated(frame(spark, ["so two words here"]), bench)
    assert kept.count() == 1 and decontam.drop_contaminated(kept, bench, least=2).count() == 0
    none = spark.createDataFrame([], BENCH)
    assert decontam.contaminations(docs, none).count() == 0
    assert decontam.drop_contaminated(docs, none).count() == docs.count()
    assert decontam.contaminations(no_docs, bench).count() == 0
    assert decontam.contaminations(docs, bench).count() == 0


def test_tokens():
    assert tokens("Äpfel, B2_c—d!") == ["äpfel", "b2", "c", "d"]
