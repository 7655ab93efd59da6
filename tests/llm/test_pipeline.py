"""The pipeline against a stage-by-stage brute-force version, on a small table."""

import random
import zlib

import numpy as np

import corpus_pipeline
from seawake.llm import rules, secrets
from tests.llm.conftest import frame, words
from tests.llm.test_decontam import slow_tiles, tokens
from tests.llm.test_packing import ids_of
from tests.llm.test_rules import slow
from tests.llm.test_simhash import slow_fingerprint, slow_groups


def corpus():
    rng = random.Random(12)
    texts = [" ".join(words(rng, rng.randint(10, 90))) for _ in range(25)]
    bench = [" ".join(words(rng, 12)) for _ in range(4)]
    texts += [texts[3], texts[3], texts[4] + " tail", "&&& " * 40, "word word " * 40, None, "", " "]
    texts += [" ".join([*words(rng, 20), bench[0], *words(rng, 20)]),
              " ".join([*words(rng, 20), *bench[1].split()[6:], "x", *bench[1].split()[:6]])]
    texts += [" ".join([*words(rng, 25), "password=Zk39fjdk39fdkXX", *words(rng, 5)])]
    return texts, bench


def slow_pipeline(rows, bench):
    """(doc_id, doc_tokens, checksum of all ids) of every document that should be packed."""
    good = []
    for i, t in rows:
        n, chars, symbols, dup, repeat, base = slow(t)
        lines = [x for x in (t or "").split("\n") if x.strip(rules.BLANKS)]
        bad = (base or 100 * symbols > rules.MAX_SYMBOL_PCT * n or 100 * dup > rules.MAX_DUP_LINE_PCT * len(lines)
               or 100 * (t or "").count("!!") > rules.MAX_SHOUT_PCT * n
               or not rules.MIN_MEAN_WORD * n <= chars <= rules.MAX_MEAN_WORD * n)
        if not bad:
            good.append((i, t))
    fp = {i: slow_fingerprint(t) for i, t in good}
    root = slow_groups(list(fp.values()))
    first = {}
    for i, _ in good:
        first[root[fp[i]]] = min(i, first.get(root[fp[i]], i))
    alone = [(i, t) for i, t in good if first[root[fp[i]]] == i]
    clean = []
    for i, t in alone:
        cover = [sum(n for *_, n in slow_tiles(tokens(b), tokens(t), 4)) / len(tokens(b)) for b in bench]
        if max(cover) < 0.5:
            clean.append((i, secrets.redact(t)))
    out = []
    for i, t in clean:
        ids = [*ids_of(t), 1]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out)


def test_run_equals_brute_force(spark, tmp_path):
    texts, bench = corpus()
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.doc_tokens, r.ids_crc32) for r in got) == slow_pipeline(list(enumerate(texts)), bench)


def test_stages_take_awkward_tables(spark, tmp_path, docs, no_docs):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for given in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, str(tmp_path))
            assert out.columns == given.columns and [f.dataType for f in out.schema] == [f.dataType for f in given.schema]
            out.write.mode("overwrite").format("noop").save()
        corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path)).write.mode("overwrite").format("noop").save()
