"""Quality rules as a short-circuit cascade, on DataFrame functions only.

Each rule rejects a text on measures of that text alone. A bounded sample tells, per rule, how
many texts it rejects (selectivity) and how long it takes (cost); the cascade evaluates rules in
the order of rejections per cost, inside one ``CASE``, so an expensive rule only runs on texts
that the cheap ones left. The order changes the work, never the verdict: a text is kept when no
rule rejects it. Costs are net: the words of the sample are cut once and stored, every rule runs warm and repeatedly over them, the time
of the same job without a rule is taken off, and costs are compared in powers of two, so that noise does not reorder rules.

Words are maximal runs outside blank, tab, line feed, vertical tab, form feed and carriage
return. Repeated words are found exactly: windows of ``WINDOW`` words are hashed, and only
windows whose hash occurs twice in the text are compared as strings.

Edge cases: a null or empty text has no words and is rejected by the word-count rule; repeated
rows, null ids and extra columns pass through untouched; an empty table stays empty (its cascade
runs in the listed order).
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.llm.common import let, settle, table

WINDOW = 8
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[ \x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

MIN_WORDS = 20
MAX_REPEATED_PCT = 30        # of the words
MAX_SYMBOL_PCT = 25          # symbol characters per hundred words
MAX_DUP_LINE_PCT = 50        # of the lines with a word
MIN_MEAN_WORD, MAX_MEAN_WORD = 2, 20
MAX_SHOUT_PCT = 25           # doubled exclamation marks per hundred words

SAMPLE_ROWS = 2000           # expected rows of the sample that orders the cascade
RUNS = 2                     # timed runs of a rule, the first of them warming up; the fastest counts
LEAST_SECONDS = 0.05         # a rule that takes less is timed again on the sample ``REPEATS`` times over
REPEATS = 4
SEED = 7


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, BLANK_RUN))


def lines_of(text: Column) -> Column:
    """\\n-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def _equal_neighbours(rows: Column, key: str, value: str) -> Column:
    """``value`` of the sorted structs ``rows`` whose ``key`` equals that of a neighbour."""
    last = F.size(rows) - 1

    def same(i: Column, j: Column) -> Column:
        return F.get(rows, i)[key] == F.get(rows, j)[key]

    hits = F.transform(F.sequence(F.lit(0), last), lambda i: F.when(
        ((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)), F.get(rows, i)[value]))
    return F.filter(hits, lambda x: x.isNotNull())


def _covered(starts: Column) -> Column:
    """Words under windows that begin at the sorted positions ``starts``."""
    following = F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1)))
    steps = F.zip_with(starts, following, lambda a, b: F.coalesce(F.least(F.lit(WINDOW), b - a), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)


def n_repeat_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows found twice or more in the text, first ones included."""
    first = F.lit(0)

    def at(i: Column) -> Column:
        return F.slice(words, i + 1, WINDOW)

    def exact(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(keyed, lambda k: let(_equal_neighbours(k, "h", "i"), spelled))

    def spelled(candidates: Column) -> Column:
        # hashes agree: compare the words themselves (they hold no blank, so joining keeps them apart)
        named = F.sort_array(F.transform(candidates, lambda i: F.struct(
            F.array_join(at(i), " ").alias("w"), i.alias("i"))))
        return let(named, lambda n: F.when(F.size(n) == 0, F.lit(0).cast("long")).otherwise(
            let(F.sort_array(_equal_neighbours(n, "w", "i")), _covered)))

    hashes = F.transform(F.sequence(first, F.size(words) - WINDOW), lambda i: F.xxhash64(at(i)))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
            .otherwise(exact(h))))


def _occurrences(text: Column, pattern: str, width: int = 1) -> Column:
    """Matches of an ASCII pattern of ``width`` characters."""
    gone = F.octet_length(text) - F.octet_length(F.regexp_replace(text, pattern, ""))
    return F.coalesce(gone / width, F.lit(0)).cast("long")


# Every measure as a function of the text and of its word array.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, w: F.size(w).cast("long"),
    "word_chars": lambda t, w: F.length(F.array_join(w, "")).cast("long"),
    "n_symbols": lambda t, w: _occurrences(t, SYMBOLS),
    "n_dup_lines": lambda t, w: let(lines_of(t), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    "n_lines": lambda t, w: F.size(lines_of(t)).cast("long"),
    "n_shouts": lambda t, w: _occurrences(t, "!!", 2),
    "n_repeat_words": lambda t, w: n_repeat_words(w),
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps a measure look-up to a Boolean column."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


RULES = (
    Rule("few_words", lambda m: m("n_words") < MIN_WORDS),
    Rule("symbols", lambda m: 100 * m("n_symbols") > MAX_SYMBOL_PCT * m("n_words")),
    Rule("shouting", lambda m: 100 * m("n_shouts") > MAX_SHOUT_PCT * m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < MIN_MEAN_WORD * m("n_words"))
         | (m("word_chars") > MAX_MEAN_WORD * m("n_words"))),
    Rule("duplicate_lines", lambda m: 100 * m("n_dup_lines") > MAX_DUP_LINE_PCT * m("n_lines")),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > MAX_REPEATED_PCT * m("n_words")),
)
BASE_RULES = ("few_words", "repeated_words")


def judge(text: Column, order: tuple[Rule, ...], words: Column | None = None) -> Column:
    """The cascade on a text: words are cut once, every other measure only where a rule asks for it."""
    return let(words_of(text) if words is None else words,
               lambda w: rejected_by(order, lambda name: MEASURES[name](text, w)))


def _seconds(part: DataFrame, verdict: Column, repeats: int) -> tuple[float, int]:
    """Fastest of ``RUNS`` passes of ``verdict`` over the rows of ``part`` taken ``repeats`` times; rows it rejects."""
    rows = part.select("t", "w", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("again"))
    best = float("inf")
    for _ in range(RUNS):
        began = time.perf_counter()
        rejected = rows.agg(F.count(verdict), F.sum(F.size("w") + F.length("t"))).first()[0]
        best = min(best, time.perf_counter() - began)
    return best, rejected // repeats


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
             text: str = "text") -> list[tuple[str, float, float]]:
    """(rule, seconds a row, rejected share) on a random sample of about ``sample_rows`` rows."""
    total = docs.count()
    if total == 0:
        return [(r.name, 1.0, 0.0) for r in rules]
    part = docs.select(F.col(text).alias("t"))
    if total > sample_rows:
        part = part.sample(fraction=sample_rows / total, seed=SEED)
    part = settle(part.coalesce(8).select("t", words_of(F.col("t")).alias("w")), "rule-sample")
    rows = max(part.count(), 1)
    seen, idle = [], {}
    for r in rules:
        verdict = judge(F.col("t"), (r,), F.col("w"))
        for repeats in (1, REPEATS):
            if repeats not in idle:
                idle[repeats] = _seconds(part, F.lit(None).cast("string"), repeats)[0]
            took, rejected = _seconds(part, verdict, repeats)
            net = (took - idle[repeats]) / repeats
            if net >= LEAST_SECONDS:
                break
        seen.append((r.name, max(net, 1e-6) / rows, rejected / rows))
    return seen


def by_rate(seen: list[tuple[str, float, float]]) -> list[str]:
    """Rule names by falling rejections per cost; costs count in powers of two, rules that reject nothing go last, cheapest first."""
    cost = {name: 2.0 ** round(math.log2(c)) for name, c, _ in seen}
    return [name for name, _, _ in sorted(seen, key=lambda x: (-x[2] / cost[x[0]], cost[x[0]]))]


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules in the order of the cascade."""
    by_name = {r.name: r for r in rules}
    return tuple(by_name[name] for name in by_rate(estimate(docs, rules, sample_rows)))


def rejected_by(order: tuple[Rule, ...], measure: Callable[[str], Column]) -> Column:
    """Name of the first rule of ``order`` that rejects, null for a kept text; later rules are not evaluated."""
    case = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in order:
        case = case.when(r.rejects(measure), F.lit(r.name))
    return case


def keep_good(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, all columns unchanged."""
    order = plan(docs, sample_rows=sample_rows)
    return docs.where(judge(F.col(text), order).isNull())


REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, order: tuple[Rule, ...] | None = None) -> DataFrame:
    """Reported measures, base verdict and cascade verdict of every row.

    The reported measures are computed for all rows. The others stand inside the cascade only: they are evaluated for the
    rows that no earlier rule has rejected.
    """
    order = order or plan(docs)
    by_name = {r.name: r for r in RULES}
    rows = docs.select("doc_id", F.col("text").alias("t"), words_of(F.col("text")).alias("w"))
    known = rows.select("doc_id", "t", "w", *[MEASURES[m](F.col("t"), F.col("w")).alias(m) for m in REPORTED])
    base = by_name[BASE_RULES[0]].rejects(F.col) | by_name[BASE_RULES[1]].rejects(F.col)
    cascade = rejected_by(order, lambda m: F.col(m) if m in REPORTED else MEASURES[m](F.col("t"), F.col("w")))
    return known.select("doc_id", *REPORTED, base.alias("base_failed"), cascade.isNull().alias("kept"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+') IF x <> ''] AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^ \x09-\x0D]')] AS l
  FROM documents),
spans AS (
  SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM d WHERE len(w) >= {WINDOW})),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM spans) WHERE n > 1),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(generate_series(0, {WINDOW - 1})) AS k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
         (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouts,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PCT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PCT} * n_words
            OR 100 * n_symbols > {MAX_SYMBOL_PCT} * n_words OR 100 * n_shouts > {MAX_SHOUT_PCT} * n_words
            OR word_chars < {MIN_MEAN_WORD} * n_words OR word_chars > {MAX_MEAN_WORD} * n_words
            OR 100 * n_dup_lines > {MAX_DUP_LINE_PCT} * n_lines) AS kept
FROM m
"""
