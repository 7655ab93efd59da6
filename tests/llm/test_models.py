"""Learnt operators: definitions against brute force, held-out accuracy, awkward input."""

import itertools
import random

import numpy as np
import pytest

from seawake.llm import pseudolm, quality, toxicity
from seawake.llm.common import table
from tests._paths import SF_MID
from tests.llm.conftest import frame, sample_texts

LABELS = "doc_id long, quality int, toxic int"


def slow_kernel(s, t, order, decay):
    total = 0.0
    for a in itertools.combinations(range(len(s)), order):
        for b in itertools.combinations(range(len(t)), order):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_subsequence_kernel_equals_definition():
    rng = random.Random(2)
    units = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(40)]
    for mark in ("abc", "aab", "cabca"):
        got = toxicity.kernel(units, mark, 3, 0.6)
        assert np.allclose(got, [slow_kernel(u, mark, 3, 0.6) for u in units])


def test_common_subsequence_length():
    def slow(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(4)
    units = ["".join(rng.choice("abcd") for _ in range(8)) for _ in range(200)]
    codes = np.array(units).view(np.uint32).reshape(len(units), -1)
    for mark in ("abcd", "dcba", "aabbccdd"):
        assert toxicity._common(codes, mark).tolist() == [slow(u, mark) for u in units]


INSULTS = ("blockhead", "nitwit", "dimbulb")


def toxic_corpus(seed, n=300):
    """Made-up sentences; every fifth document holds two insults."""
    rng = random.Random(seed)
    syllables = ["ta", "ren", "mo", "li", "sor", "ve", "un", "da", "per", "ish"]
    out = []
    for i in range(n):
        w = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(60)]
        if i % 5 == 0:
            for x in rng.sample(INSULTS, 2):
                w[rng.randrange(60)] = x
        out.append((". ".join(" ".join(w[k:k + 10]) for k in range(0, 60, 10)), int(i % 5 == 0)))
    return out


def test_plain_gapped_and_spelled_insults_are_found():
    rows = toxic_corpus(1)
    model = toxicity.fit([t for t, y in rows if y], [t for t, y in rows if not y])
    fresh = toxic_corpus(2, 100)
    assert np.mean([(s >= 0.5) == bool(y) for s, (_, y) in zip(model.score([t for t, _ in fresh]), fresh, strict=True)]) > 0.97
    clean = next(t for t, y in fresh if not y)
    low = model.score([clean])[0]
    for shape in ("{0}", "{0}!!", "B.l-o.c-k.h-e.a-d", "n i t w i t", "bloxckhead", "BLOCKHEAD"):
        text = clean + f" You {shape.format('nitwit')} and dimbulb."
        assert model.score([text])[0] > max(0.5, low)


def test_toxicity_of_awkward_texts_and_without_labels(spark, docs, no_docs):
    rows = toxic_corpus(1, 100)
    model = toxicity.fit([t for t, y in rows if y], [t for t, y in rows if not y])
    got = toxicity.scored(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(no_docs, model).count() == 0
    assert toxicity.fit([], []).score(["x", ""]) == [0.0, 0.0]
    assert toxicity.fit(["x"], []).score(["x"]) == [1.0]
    labels = spark.createDataFrame([], LABELS)
    assert toxicity.training_rows(docs, labels, "toxic", {1: 5, 0: 5}) == []


def test_training_rows_are_bounded_and_outside_the_held_out_fold(spark):
    docs = frame(spark, [f"text {i}" for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(None, 1, 1), (3, 1, 0)], LABELS)
    import zlib
    rows = toxicity.training_rows(docs, labels, "quality", {1: 10, 0: 1000})
    ids = [int(t.split()[1]) for t, _ in rows]
    assert sum(y for _, y in rows) == 10 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert all(y == i % 2 for i, (_, y) in zip(ids, rows, strict=True))


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 2000, 5000])
def test_chunks_overlap_and_cover_the_whole_text(n):
    text = "".join(chr(33 + i % 90) for i in range(n))
    got, step = quality.chunks(text), quality.CHUNK - quality.OVERLAP
    back = bytearray(n)
    for i, row in enumerate(got):
        part = row[row != quality.PAD].astype(np.uint8).tobytes()
        back[i * step:i * step + len(part)] = part
    assert bytes(back).decode() == text


def test_gradients_equal_differences():
    net, rng = quality.Network(), np.random.default_rng(0)
    docs = [quality.chunks("abc &&& " * 200), quality.chunks("hello there " * 20), quality.chunks("")]
    y = np.array([0.0, 1.0, 1.0], np.float32)
    net.p = {k: v.astype(np.float64) + (rng.normal(0, 0.1, v.shape) if k == "out" else 0) for k, v in net.p.items()}
    net.p["offset"] += 0.05                                # away from the kink that padding sits on
    _, grads = net.step(docs, y)
    for k, g in grads.items():
        flat = np.argsort(-np.abs(g).ravel())[:3]
        for at in flat:
            old, eps = net.p[k].flat[at], 1e-5
            net.p[k].flat[at] = old + eps
            up, _ = net.step(docs, y)
            net.p[k].flat[at] = old - eps
            down, _ = net.step(docs, y)
            net.p[k].flat[at] = old
            extra = 1e-4 * old if k == "out" else 0        # the weight decay is in the gradient only
            assert abs((up - down) / (2 * eps) + extra - g.flat[at]) < 2e-4


def test_scores_do_not_depend_on_the_batch():
    net = quality.Network()
    net.p["out"][:] = np.linspace(-1, 1, len(net.p["out"]))
    texts = [t or "" for t in sample_texts()]
    assert np.allclose(net.score(texts), [net.score([t])[0] for t in texts], atol=1e-5)


def test_quality_of_awkward_texts_and_without_labels(docs, no_docs):
    net = quality.fit([("good text here " * 5, 1), ("&&& *** " * 9, 0)] * 20, epochs=2)
    got = toxicity.scored(docs, net).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(no_docs, net).count() == 0
    assert quality.fit([]).score(["x"]) == [0.0]
    assert quality.fit([("x", 1)]).score(["x", ""]) == [1.0, 1.0]


def test_pseudo_likelihood_counts_equal_brute_force(spark, docs):
    counts = pseudolm._counted(docs, pseudolm.token_numbers, pseudolm.BUCKETS)
    texts = [r.text or "" for r in docs.collect()]
    want = np.zeros(pseudolm.BUCKETS, np.int64)
    for t in texts:
        for n in pseudolm.token_numbers(t):
            want[n] += 1
    assert (counts == want).all()
    classes = pseudolm.classes_of(counts)
    contexts = pseudolm._counted(docs, lambda t: pseudolm.windows(classes[pseudolm.token_numbers(t)]),
                                 pseudolm.CONTEXTS * pseudolm.CLASSES)
    assert contexts.sum() == counts.sum()


def test_pseudo_likelihood_is_normalised_and_learns():
    rng = random.Random(3)
    texts = [" ".join("alpha beta gamma delta".split() * 5) for _ in range(30)] + [
        " ".join(rng.choice(["red", "green", "blue"]) for _ in range(30)) for _ in range(10)]
    numbers = [pseudolm.token_numbers(t) for t in texts]
    counts = np.bincount(np.concatenate(numbers), minlength=pseudolm.BUCKETS)
    classes = pseudolm.classes_of(counts)
    table_ = np.bincount(np.concatenate([pseudolm.windows(classes[n]) for n in numbers]),
                         minlength=pseudolm.CONTEXTS * pseudolm.CLASSES)
    context = pseudolm.train(table_)
    token = pseudolm.within_class(counts, classes)
    assert np.allclose(np.exp(context.reshape(-1, pseudolm.CLASSES)).sum(axis=1), 1, atol=1e-4)
    assert np.allclose(np.bincount(classes, weights=np.exp(token), minlength=pseudolm.CLASSES)[np.unique(classes)], 1)
    model = pseudolm.Model(classes, context, token)
    n, known = model.score("alpha beta gamma delta alpha beta gamma delta")
    _, mixed = model.score("delta delta alpha alpha gamma gamma beta beta")
    assert n == 8 and known > mixed
    words = pseudolm.token_numbers("alpha beta gamma")
    c = classes[words]
    edge = pseudolm.EDGE
    padded = [edge, edge, *c, edge, edge]
    table4 = context.reshape(*pseudolm.WINDOW, pseudolm.CLASSES)
    group = [x // pseudolm.PER_GROUP for x in padded]
    direct = sum(table4[group[i], padded[i + 1], padded[i + 3], group[i + 4], c[i]] + token[w]
                 for i, w in enumerate(words))
    assert abs(model.score("alpha beta gamma")[1] - direct) < 1e-4
    assert model.score("") == model.score(" \n") == (0, 0.0)


def test_pseudo_likelihood_of_awkward_tables(spark, docs, no_docs):
    got = pseudolm.pseudo_likelihood(docs, pseudolm.fit(docs)).collect()
    assert len(got) == docs.count()
    assert all((r.n_tokens == 0) == (r.mean_log_probability is None) and r.pseudo_log_likelihood <= 0 for r in got)
    assert pseudolm.pseudo_likelihood(no_docs, pseudolm.fit(no_docs)).count() == 0


@pytest.mark.parametrize(("query", "label", "least"), [(toxicity.op1_toxicity, "toxic", 0.95), (quality.op9_quality, "quality", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    got = query(spark, SF_MID)
    n = table(spark, SF_MID, "documents").count()
    rows = got.join(table(spark, SF_MID, "labels"), "doc_id").where("held_out").select("predicted", label).collect()
    assert got.count() == n
    assert np.mean([a == b for a, b in rows]) >= least


SCRIPTS = {"greek": 0x3b1, "cyrillic": 0x430, "arabic": 0x620, "cjk": 0x4e00}


def in_script(text, first):
    """The text with its letters a-z replaced by letters of another script."""
    letters = [c for c in map(chr, range(first, first + 80)) if c.isalpha() and c.lower() == c][:26]
    return text.translate(dict(zip(range(ord("a"), ord("z") + 1), letters, strict=False))) if len(letters) == 26 else None


def test_toxicity_answers_in_every_script():
    texts, labels = zip(*toxic_corpus(3), strict=True)
    for name, first in SCRIPTS.items():
        other = [in_script(t.lower(), first) for t in texts]
        assert None not in other, name
        model = toxicity.fit([t for t, y in zip(other, labels, strict=True) if y], [t for t, y in zip(other, labels, strict=True) if not y])
        got = [s >= 0.5 for s in model.score(other)]
        assert np.mean([a == bool(y) for a, y in zip(got, labels, strict=True)]) >= 0.95, name
        assert np.mean([a for a, y in zip(got, labels, strict=True) if y]) >= 0.9, name


def test_landmarks_may_hold_more_than_64_letters():
    marks = [f"^{''.join(chr(0x4e00 + 6 * k + i) for i in range(6))}$" for k in range(30)]
    own = np.array([toxicity.kernel([m], m)[0] for m in marks])
    got = toxicity.Model(marks, own, np.ones(len(marks)), 0.0).responses(marks)
    assert np.allclose(got, np.eye(len(marks)))


def test_only_texts_of_mostly_the_same_words_are_copies():
    import zlib
    rng = random.Random(8)
    common = sorted((f"w{i}" for i in range(5000)), key=lambda x: zlib.crc32(x.encode()))
    texts = [{*common[:2], *(f"t{i}_{k}" for k in range(40))} for i in range(20)]       # equal smallest hashes only
    texts += [{*rng.sample(sorted(t), 40), "other"} for t in texts[:10]] + [texts[3], set(), set()]
    assert toxicity._distinct(texts) == [*range(20), 31]
