"""Documents that hold the awkward cases every operator must take."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from seawake.llm.common import prepare

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns whose names an operator might use itself
    T.StructField("fingerprint", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("kept", T.BooleanType()), T.StructField("key", T.StringType()),
    T.StructField("t", T.StringType()), T.StructField("group", T.IntegerType())])

EMPTY_WORDS = ["", " \t\n\x0b\x0c\r ", None]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnoprstuväéß") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def sample_texts(seed: int = 3) -> list[str | None]:
    """Ordinary, null, blank, repeated, near-repeated, very long and odd texts."""
    rng = random.Random(seed)
    texts: list[str | None] = [" ".join(words(rng, rng.randint(1, 120))) + ".\n" for _ in range(30)]
    base = words(rng, 200)
    texts += [" ".join(base)] * 3 + [" ".join([*base[:100], "other", *base[101:]]), " ".join(base[:-1])]
    line = " ".join(words(rng, 9))
    texts += ["\n".join([line] * 6), " ".join(words(rng, 5) * 30), " ".join(words(rng, 20_000))]
    texts += [*EMPTY_WORDS, "a", "A b", "  lead and trail  ", "x" * 5000, "the " * 300, "İstanbul ſtraße   KK 😀"]
    return texts


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), "f", 0.5, True, "k", "t", 1)
            for i, t in zip(ids, texts, strict=True)]
    return prepare(spark).createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def docs(spark):
    """The sample texts, one row repeated, two rows without an id."""
    texts = sample_texts()
    return frame(spark, [*texts, texts[0], texts[1], None], [*range(len(texts)), 0, None, None]).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return prepare(spark).createDataFrame([], DOCUMENTS)
