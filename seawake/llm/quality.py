"""Quality scores by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by ``OVERLAP`` and cover the whole
document. Bytes are embedded, learned filters of ``WIDTH`` bytes slide over each chunk in steps of
``STRIDE``, and every filter's largest response in a chunk is kept. A document's features are, per
filter, the largest and the mean of these chunk maxima; a logistic layer combines them into one
probability. Embeddings, filters and the logistic layer are trained together (Adam, own backward
pass) on a bounded sample of labelled rows; an epoch sees at most ``EPOCH_CHUNKS`` random chunks of
each training document.

Scoring passes once over all whole texts, shuffles nothing and holds ``BLOCK_CHUNKS`` chunks at a
time, however long a text is.

Edge cases: null and empty texts are one chunk of padding; without labelled rows of both classes
every score is the share of good labels (zero without any); repeated rows are scored as rows, and so are null
ids (their ``held_out`` is null: they belong to no fold).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.llm.common import table
from seawake.llm.toxicity import held_out, scored, training_rows

CHUNK, OVERLAP = 1024, 64
EMBED, WIDTH, STRIDE, FILTERS = 8, 16, 4, 32
BLOCK_CHUNKS = 64
EPOCHS, EPOCH_CHUNKS, BATCH_DOCS, RATE = 8, 4, 32, 0.01
LEAST_STEPS = 500
SAMPLE_GOOD, SAMPLE_BAD = 2500, 1000
THRESHOLD = 0.3
PAD = 256
SEED = 9


def chunks(text: str) -> np.ndarray:
    """(chunks, CHUNK) byte values of a whole text, the last chunk padded."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    out = np.full((n, CHUNK), PAD, np.int16)
    for i in range(n):
        part = raw[i * step:i * step + CHUNK]
        out[i, :len(part)] = part
    return out


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32),
            "filters": (rng.normal(0, 1, (WIDTH * EMBED, FILTERS)) / np.sqrt(WIDTH * EMBED)).astype(np.float32),
            "offset": np.zeros(FILTERS, np.float32),
            "out": np.zeros(2 * FILTERS, np.float32),
            "bias": np.zeros(1, np.float32),
        }
        self.p["embed"][PAD] = 0
        self.constant: float | None = None

    def _windows(self, block: np.ndarray) -> np.ndarray:
        """(chunks, positions, WIDTH * EMBED) embedded windows of a block of chunks."""
        e = self.p["embed"][block]
        n, c, d = e.shape
        s0, s1, s2 = e.strides
        shape = (n, (c - WIDTH) // STRIDE + 1, WIDTH * d)
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(e, shape, (s0, s1 * STRIDE, s2)))

    def _maxima(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest rectified response of every filter in every chunk, where it is, and the windows."""
        w = self._windows(block)
        r = w @ self.p["filters"]
        at = r.argmax(axis=1)
        top = np.take_along_axis(r, at[:, None, :], 1)[:, 0] + self.p["offset"]
        return np.maximum(top, 0), at, w

    def features(self, text_chunks: np.ndarray) -> np.ndarray:
        best, total = np.zeros(FILTERS), np.zeros(FILTERS)
        for lo in range(0, len(text_chunks), BLOCK_CHUNKS):
            top = self._pooled(text_chunks[lo:lo + BLOCK_CHUNKS])
            best = np.maximum(best, top.max(axis=0))
            total += top.sum(axis=0)
        return np.concatenate([best, total / len(text_chunks)])

    def _pooled(self, block: np.ndarray) -> np.ndarray:
        r = (self._windows(block) @ self.p["filters"]).max(axis=1)
        return np.maximum(r + self.p["offset"], 0)

    def score(self, texts: list[str]) -> list[float]:
        """Probability of good quality of every text; short texts share blocks."""
        if self.constant is not None:
            return [self.constant] * len(texts)
        out = np.zeros((len(texts), 2 * FILTERS))
        for part in _filled(texts):
            if len(part) == 1:
                out[part[0][0]] = self.features(part[0][1])
                continue
            top = self._pooled(np.concatenate([c for _, c in part]))
            at = 0
            for i, c in part:
                mine = top[at:at + len(c)]
                out[i] = np.concatenate([mine.max(axis=0), mine.mean(axis=0)])
                at += len(c)
        z = out @ self.p["out"] + self.p["bias"]
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).tolist()

    def step(self, docs: list[np.ndarray], y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch of documents."""
        p, owner = self.p, np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        block = np.concatenate(docs)
        top, at, windows = self._maxima(block)
        sizes = np.bincount(owner, minlength=len(docs))[:, None]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        best = np.maximum.reduceat(top, starts)
        x = np.concatenate([best, np.add.reduceat(top, starts) / sizes], axis=1)
        prob = 1 / (1 + np.exp(-np.clip(x @ p["out"] + p["bias"], -30, 30)))
        loss = -np.mean(y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9))
        dz = ((prob - y) / len(y)).astype(np.float32)
        dx = dz[:, None] * p["out"][None, :]
        won = top == best[owner]
        won = won / np.maximum(np.add.reduceat(won, starts, dtype=np.float32), 1)[owner]
        dtop = (dx[owner, :FILTERS] * won + dx[owner, FILTERS:] / sizes[owner]) * (top > 0)
        seen = windows[np.arange(len(block))[:, None], at]                      # (chunks, filters, window)
        dseen = dtop[:, :, None] * p["filters"].T[None]
        places = at[:, :, None] * STRIDE + np.arange(WIDTH)
        ids = block[np.arange(len(block))[:, None, None], places]
        dembed = np.zeros_like(p["embed"])
        np.add.at(dembed, ids.ravel(), dseen.reshape(-1, EMBED))
        dembed[PAD] = 0
        return float(loss), {
            "embed": dembed, "filters": np.einsum("cf,cfw->wf", dtop, seen), "offset": dtop.sum(axis=0),
            "out": x.T @ dz + 1e-4 * p["out"], "bias": dz.sum(keepdims=True)}


def _filled(texts: list[str]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Texts gathered until their chunks fill a block; a text longer than a block comes alone."""
    held, n = [], 0
    for i, t in enumerate(texts):
        c = chunks(t)
        if held and n + len(c) > BLOCK_CHUNKS:
            yield held
            held, n = [], 0
        held.append((i, c))
        n += len(c)
    if held:
        yield held


def fit(rows: list[tuple[str, int]], epochs: int = EPOCHS,
        seed: int = SEED) -> Network:
    """Train on (text, label) rows."""
    net, rng = Network(seed), np.random.default_rng(seed)
    y = np.array([label for _, label in rows], np.float32)
    if len(set(y.tolist())) < 2:
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    cut = [chunks(t) for t, _ in rows]
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    batches = -(-len(rows) // BATCH_DOCS)
    epochs = max(epochs, -(-LEAST_STEPS // batches))        # a small sample is passed more often
    t, total = 0, epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), BATCH_DOCS):
            pick = order[lo:lo + BATCH_DOCS]
            docs = [cut[i] if len(cut[i]) <= EPOCH_CHUNKS
                    else cut[i][np.sort(rng.choice(len(cut[i]), EPOCH_CHUNKS, replace=False))] for i in pick]
            _, grads = net.step(docs, y[pick])
            t += 1
            rate = RATE * (1 - 0.9 * t / total)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.p[k] = (net.p[k] - rate * (first[k] / (1 - 0.9 ** t)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return net


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = training_rows(docs, table(spark, sf_dir, "labels"), "quality", {1: SAMPLE_GOOD, 0: SAMPLE_BAD})
    return scored(docs, fit(rows)).select("doc_id", held_out().alias("held_out"), "score",
                                          (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
