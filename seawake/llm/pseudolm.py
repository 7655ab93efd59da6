"""Document scores by masked pseudo-likelihood.

Every token is masked in turn and predicted from its neighbours on both sides; the sum of the
conditional log-probabilities scores the document.

**Tokens** are blank-separated words, lower-cased (A-Z), hashed into ``BUCKETS`` token numbers; a number's
upper bits hash the word's ending. The most frequent ``OWN`` numbers of the corpus are classes of
their own, all others are classed by their ending. p(token | sides) = p(class | sides) · p(token | class).

**Network.** The window holds two tokens on each side of the masked one (or the document's edge): the neighbours by
class, the tokens beyond them by coarser group. Each of the four places is embedded, the embeddings are added and passed
through a tanh layer to a softmax over the classes. Training is exact on the whole corpus: such windows have a bounded
number of contexts, so the counts of (window, class) over *all* documents are everything the loss depends on.
Tasks count their documents, the counts are summed in a shuffle, and the network is trained in numpy by full-batch
Adam on the summed table. p(token | class) comes from the token counts of all documents, smoothed by ``SMOOTH``.

What reaches the driver is bounded by the number of classes and buckets, never by the corpus; what
is counted and shuffled grows with it. Scoring is one more pass over all whole texts, without a shuffle.

Edge cases: null, empty and blank texts have no tokens, a sum of zero and a null mean; a
single-token text is predicted from its two edges; repeated rows and null ids are scored as rows; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import map_columns, prepare, strings, table

ENDING_BITS, WORD_BITS = 6, 10
BUCKETS = 1 << (ENDING_BITS + WORD_BITS)
OWN, ENDINGS = 32, 16
CLASSES = OWN + ENDINGS
PER_GROUP = 8                        # classes in a group of the outer places
EDGE = CLASSES                       # class outside the document; its group is one of its own
SIDES, GROUPS = CLASSES + 1, CLASSES // PER_GROUP + 1
WINDOW = (GROUPS, SIDES, SIDES, GROUPS)      # second left, left, right, second right
CONTEXTS = GROUPS * SIDES * SIDES * GROUPS
HIDDEN = 32
STEPS, RATE = 120, 0.03
SMOOTH = 0.5
MEMORY_WORDS = 500_000
SEED = 6


class Numbers(dict):
    """Token number of a word, remembered for up to ``MEMORY_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        ending = zlib.crc32(word[-2:]) & ((1 << ENDING_BITS) - 1)
        n = ending << WORD_BITS | (zlib.crc32(word) >> 8) & ((1 << WORD_BITS) - 1)
        self[word] = n
        return n


_NUMBERS = Numbers()


def token_numbers(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_NUMBERS.__getitem__, words), np.int64, len(words))


def windows(classes: np.ndarray) -> np.ndarray:
    """Index of (window, class) of every token."""
    padded = np.concatenate([[EDGE, EDGE], classes, [EDGE, EDGE]])
    groups = padded // PER_GROUP
    n = len(classes)
    window = ((groups[:n] * SIDES + padded[1:n + 1]) * SIDES + padded[3:n + 3]) * GROUPS + groups[4:n + 4]
    return window * CLASSES + classes


COUNT = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])


def _counted(docs: DataFrame, keys: Callable[[str], np.ndarray], size: int) -> np.ndarray:
    """Occurrences of every key below ``size`` over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            held, n = [], 0
            for text in strings(b.column(0)):
                k = keys(text)
                held.append(k)
                n += len(k)
                if n >= 1 << 20:
                    total += np.bincount(np.concatenate(held), minlength=size)
                    held, n = [], 0
            if n:
                total += np.bincount(np.concatenate(held), minlength=size)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 100_000):
            part = at[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=COUNT.names)

    summed = docs.select("text").mapInArrow(run, COUNT).groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)                       # at most ``size`` rows came back
    out[summed["key"].to_numpy()] = summed["n"].to_numpy()
    return out


def classes_of(counts: np.ndarray) -> np.ndarray:
    """Class of every token number: own classes for the most frequent, else by ending."""
    out = OWN + (np.arange(BUCKETS) >> WORD_BITS) % ENDINGS
    top = np.lexsort((np.arange(BUCKETS), -counts))[:OWN]
    out[top[counts[top] > 0]] = np.arange(int((counts[top] > 0).sum()))
    return out


def train(counts: np.ndarray, steps: int = STEPS, hidden: int = HIDDEN, seed: int = SEED) -> np.ndarray:
    """log p(class | window), indexed like ``windows``, of the network trained on the counts."""
    rng = np.random.default_rng(seed)
    n = counts.reshape(CONTEXTS, CLASSES).astype(np.float32)
    total = max(float(n.sum()), 1.0)
    n /= total
    mass = n.sum(axis=1, keepdims=True)
    prior = np.log(n.sum(axis=0) + 1 / (total + CLASSES)).astype(np.float32)
    p = {f"place{k}": rng.normal(0, 0.3, (size, hidden)) for k, size in enumerate(WINDOW)}
    p |= {"out": rng.normal(0, 0.1, (hidden, CLASSES)), "bias": prior}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}

    def forward() -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = (p[f"place{k}"] for k in range(4))
        h = np.tanh(a[:, None, None, None] + b[None, :, None, None] + c[None, None, :, None] + d[None, None, None])
        h = h.reshape(CONTEXTS, hidden)
        z = h @ p["out"] + p["bias"]
        z -= z.max(axis=1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    for t in range(1, steps + 1):
        h, logp = forward()
        dz = mass * np.exp(logp) - n
        dh = (dz @ p["out"].T) * (1 - h * h)
        grid = dh.reshape(*WINDOW, hidden)
        grads = {f"place{k}": grid.sum(axis=tuple(j for j in range(4) if j != k)) for k in range(4)}
        grads |= {"out": h.T @ dz, "bias": dz.sum(axis=0)}
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p[k] = (p[k] - RATE * (1 - 0.9 * t / steps) * (first[k] / (1 - 0.9 ** t))
                    / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-9)).astype(np.float32)
    return forward()[1].astype(np.float32).ravel()


def within_class(counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log p(token | class) of every token number, smoothed over the class's numbers."""
    n = counts + SMOOTH
    return np.log(n / np.bincount(classes, weights=n, minlength=CLASSES)[classes])


class Model:
    def __init__(self, classes: np.ndarray, context: np.ndarray, token: np.ndarray):
        self.classes, self.context, self.token = classes, context, token

    def score(self, text: str) -> tuple[int, float]:
        """(tokens, summed conditional log-probability) of a whole text."""
        numbers = token_numbers(text)
        if not len(numbers):
            return 0, 0.0
        found = self.context[windows(self.classes[numbers])].sum(dtype=np.float64)
        return len(numbers), float(found + self.token[numbers].sum())


def fit(docs: DataFrame) -> Model:
    """Count all documents, then train the network on the counts."""
    spark = prepare(docs.sparkSession)
    counts = _counted(docs, token_numbers, BUCKETS)
    classes = classes_of(counts)
    shared = spark.sparkContext.broadcast(classes)
    contexts = _counted(docs, lambda t: windows(shared.value[token_numbers(t)]), CONTEXTS * CLASSES)
    return Model(classes, train(contexts), within_class(counts, classes))


SCORE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                      T.StructField("pseudo_log_likelihood", T.DoubleType()),
                      T.StructField("mean_log_probability", T.DoubleType())])


def pseudo_likelihood(docs: DataFrame, model: Model) -> DataFrame:
    """Token count, summed and mean conditional log-probability of every row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [shared.value.score(t) for t in strings(b.column(1))]
        return pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.int64()), pa.array([n for n, _ in rows], pa.int64()),
             pa.array([s for _, s in rows], pa.float64()),
             pa.array([s / n if n else None for n, s in rows], pa.float64())], names=SCORE.names)

    return map_columns(docs.select("doc_id", "text"), run, SCORE)


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood(docs, fit(docs))
