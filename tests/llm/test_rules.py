import re
import time

from pyspark.sql import functions as F

from seawake.llm import rules
from tests.llm.conftest import frame


def slow(text):
    """Every contract measure straight from its definition."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    spans = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    twice = {s for s in set(spans) if spans.count(s) > 1} if len(spans) < 3000 else set()
    covered = {i + k for i, s in enumerate(spans) if s in twice for k in range(8)}
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


EXTRA = [" ".join(["a b c d e f g h i"] * 5), "x " * 40 + "\n" + "x " * 40, "&&& " * 30 + "word " * 30,
         "one two three four five six seven eight nine ten " * 2 + " ".join(map(str, range(50))),
         "é ü word\x0bnext\x0cpage\rend " * 10, "a  b\t\tc\n\n\n" * 20]


def test_measures_equal_brute_force(spark, docs):
    df = docs.unionByName(frame(spark, EXTRA, range(1000, 1000 + len(EXTRA))))
    want = sorted(((r.doc_id, *slow(r.text)) for r in df.collect()), key=str)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in rules.judged(df).collect()), key=str)
    assert got == want


def test_verdict_is_the_same_in_any_order(spark, docs):
    df = docs.unionByName(frame(spark, EXTRA, range(1000, 1000 + len(EXTRA))))
    columns = [rules.judge(df["text"], order).isNull().alias(f"o{i}")
               for i, order in enumerate((rules.RULES, rules.RULES[::-1]))]
    for r in df.select(*columns).collect():
        assert r.o0 == r.o1
    assert rules.keep_good(df).count() == df.select(columns[0]).where("o0").count()


def test_kept_implies_base_passed_and_columns_stay(docs):
    got = rules.judged(docs).collect()
    assert not any(r.kept and r.base_failed for r in got)
    assert rules.keep_good(docs).columns == docs.columns


def long_texts(n, junk):
    """Long texts, no window twice in any; the share ``junk`` of them is full of symbols."""
    return [" ".join(f"w{i}x{k}" for k in range(600)) + (" ### *** %%%" * 120 if i < junk * n else "") for i in range(n)]


def test_order_is_by_rejections_per_cost(spark):
    seen = [("dear", 8e-5, 0.5), ("none_dear", 9e-5, 0.0), ("cheap", 1e-6, 0.4), ("same_cost", 1.2e-6, 0.41), ("none", 1e-6, 0.0)]
    assert rules.by_rate(seen) == ["same_cost", "cheap", "dear", "none", "none_dear"]
    df = frame(spark, long_texts(300, 0.8) + ["word"] * 20)
    got = {n: (s, share) for n, s, share in rules.estimate(df)}
    assert abs(got["symbols"][1] - 0.75) < 0.01 and abs(got["few_words"][1] - 0.0625) < 0.01 and got["duplicate_lines"][1] == 0
    assert got["repeated_words"][0] > 4 * got["few_words"][0]           # windows cost more than a count, words being cut
    order = [r.name for r in rules.plan(df)]
    assert order.index("symbols") < order.index("repeated_words")       # it spares the dear rule three quarters of the rows
    assert order.index("few_words") < order.index("repeated_words") and order.index("symbols") < order.index("duplicate_lines")


def test_order_saves_work(spark):
    df = frame(spark, long_texts(400, 0.9) * 5).cache()
    df.count()

    def seconds(order):
        best = 99.0
        for _ in range(3):
            began = time.perf_counter()
            df.agg(F.count(rules.judge(df["text"], order))).collect()
            best = min(best, time.perf_counter() - began)
        return best

    order = rules.plan(df)
    assert seconds(order) < 0.8 * seconds(order[::-1])


def test_unreported_measures_stand_inside_the_cascade_only(docs):
    plan = rules.judged(docs, rules.RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "!!" in plan
    for line in plan.split("\n"):                    # the doubled exclamation marks occur behind a CASE of the same line only
        assert "!!" not in line or 0 <= line.index("CASE WHEN") < line.index("!!")
    assert " AS n_shouts" not in plan and " AS n_lines" not in plan


def test_empty_table(no_docs):
    assert rules.judged(no_docs).count() == 0
    assert rules.keep_good(no_docs).count() == 0
