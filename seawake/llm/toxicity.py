"""Toxicity scores: a subsequence string-kernel machine with Nyström landmarks.

**Units.** A text is cut into sentences and those into units: blank-separated words, lower-cased,
reduced to letters and digits, between border marks (``^word$``); runs of single characters
("i d i o t") are joined to one unit, and words longer than ``UNIT`` characters are read in
overlapping windows.

**Kernel.** The subsequence kernel of order ``ORDER``: two strings are as similar as the common
subsequences of that many characters they hold, each weighted ``DECAY`` to the power of its span, so
inserted characters lower the value without destroying it. A unit's response to a landmark is its
kernel value relative to the landmark's own, cut at one, to the power ``POWER``. Responses under ``FLOOR``, and units whose
longest common subsequence with the landmark is shorter than ``SHARED`` of it, count as zero. A sentence
responds to a landmark as its best unit does.

**Nyström machine.** Landmarks are character sequences far denser in toxic than in clean labelled
documents. Responses are mapped by the inverse square root of the landmarks' own kernel matrix, and a
linear support vector machine (squared hinge, class-balanced) is trained on labelled sentences: every
responding sentence of a clean document, and of a toxic document the one sentence that scores best
(its witness), chosen anew in ``ROUNDS`` rounds. Gapped copies of the landmarks (one character put in)
are added to the toxic side. A document's score is a logistic, fitted on the training documents, of its best
sentence margin, of the evidence summed over its sentences and of the evidence per sentence.

Only the bounded sample of labelled rows (``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``, ``SAMPLE_CHARS``) is
brought together for training. Scoring passes once over all whole texts and shuffles nothing; a
task keeps the units it has already judged (at most ``MEMORY_UNITS``).

Edge cases: null and empty texts have no units and get the score of an empty sentence; without
labelled rows of both classes every score is the share of toxic labels (zero without any); repeated rows
are scored as rows, and so are null ids (their ``held_out`` is null: they belong to no fold).
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import map_columns, prepare, strings, table

ORDER = 3
DECAY = 0.7
FLOOR = 0.4
SHARED = 0.8
POWER = 3                    # responses are raised to it: a power of a kernel is a kernel, and near misses fade
SOFT = 0.02                  # added to the evidence per sentence before its logarithm
UNIT = 24
MAX_LANDMARKS = 48
GRAM = (4, 9)                # characters of a landmark, border marks included
PENALTY, NEARLY = 10, 0.9
SEED_GRAM = (4, 5)           # lengths on which landmarks are first looked for
MIN_SUPPORT = 0.025          # of the distinct toxic training documents must hold the landmark
MIN_PURITY = 0.93            # toxic share of a landmark's density
COPY, SKETCH = 0.8, 64       # near copies share so much of their words; hashes that point at them
ROUNDS = 3
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3500
SAMPLE_CHARS = 20_000
MEMORY_UNITS = 400_000
FOLDS, HELD_OUT = 5, 0
SEED = 1

_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n+")
_SPELLED = re.compile(r"(?<!\S)\S\s\S(?:\s\S)+(?!\S)")
_OTHER = re.compile(r"[\W_]+")
_CODES = sys.maxunicode + 1  # of a letter table; pages of scripts that no landmark or text uses are never touched


def held_out() -> F.Column:
    """Whether a document is outside the training folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT


def units_of(word: str) -> list[str]:
    """Units of one blank-separated, lower-cased word."""
    core = _OTHER.sub("", word)
    if not core:
        return []
    if len(core) <= UNIT:
        return [f"^{core}$"]
    step = UNIT // 2
    return [("^" if i == 0 else "") + core[i:i + UNIT] + ("$" if i + UNIT >= len(core) else "")
            for i in range(0, len(core) - step, step)]


def words_of(text: str) -> list[str]:
    """Blank-separated words of lower-cased ``text`` plus its spelled-out ones."""
    spelled = [re.sub(r"\s", "", m) for m in _SPELLED.findall(text)]
    return text.split() + spelled


def kernel(units: list[str], landmark: str, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of every unit with ``landmark`` (dynamic programme, vectorised over units)."""
    n, m = len(units), len(landmark)
    width = max(map(len, units), default=0)
    codes = np.zeros((n, max(width, 1)), np.int32)
    flat = np.array(units, dtype=f"U{max(width, 1)}") if n else np.zeros(0, "U1")
    codes[:, :] = flat.view(np.int32).reshape(n, -1) if n else 0
    target = np.array([ord(c) for c in landmark], np.int32)
    total = np.zeros(n)
    # open_[i][:, j]: weight of subsequences of length i inside the unit so far and landmark[:j]
    open_ = [np.ones((n, m + 1))] + [np.zeros((n, m + 1)) for _ in range(order - 1)]
    for p in range(width):
        same = codes[:, p, None] == target[None, :]
        if not same.any():
            for i in range(1, order):
                open_[i] *= decay
            continue
        total += (same * open_[order - 1][:, :m]).sum(axis=1) * decay ** 2
        for i in range(order - 1, 0, -1):
            run = np.zeros(n)
            fresh = same * open_[i - 1][:, :m] * decay ** 2
            for j in range(m):
                run = run * decay + fresh[:, j]
                open_[i][:, j + 1] = open_[i][:, j + 1] * decay + run
    return total


def _common(codes: np.ndarray, landmark: str) -> np.ndarray:
    """Length of the longest common subsequence of every row of character codes with ``landmark`` (bit-parallel)."""
    m = len(landmark)
    lut = np.zeros(_CODES, np.uint32)
    for j, c in enumerate(landmark):
        lut[ord(c)] |= np.uint32(1 << j)
    lut[0] = 0
    full = np.uint32((1 << m) - 1)
    v = np.full(len(codes), full, np.uint32)
    for p in range(codes.shape[1]):
        u = v & lut[codes[:, p]]
        v = ((v + u) | (v - u)) & full
    return m - np.bitwise_count(v)


@dataclass
class Model:
    """A trained machine; ``judge`` keeps what it learnt about units while it runs."""

    landmarks: list[str]
    own: np.ndarray                    # K(l, l) of each landmark
    weights: np.ndarray                # on responses: Nyström map and machine folded into one
    bias: float
    logistic: np.ndarray = field(default_factory=lambda: np.zeros(4))
    constant: float | None = None      # the score of every text when nothing could be learnt
    _known: dict[str, np.ndarray | None] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": {}}

    def responses(self, units: list[str]) -> np.ndarray:
        """(units, landmarks) responses; the kernel runs only where the longest common subsequence is long enough."""
        out = np.zeros((len(units), len(self.landmarks)))
        if not units:
            return out
        width = max(map(len, units))
        codes = np.array(units, dtype=f"U{width}").view(np.uint32).reshape(len(units), -1)
        alphabet = sorted({c for mark in self.landmarks for c in mark})
        missing = np.zeros((len(units), len(self.landmarks)), np.uint16)
        for lo in range(0, len(alphabet), 64):               # a word of bits for every 64 letters
            bit = {c: 1 << i for i, c in enumerate(alphabet[lo:lo + 64])}
            lut = np.zeros(_CODES, np.uint64)
            lut[[ord(c) for c in bit]] = np.array(list(bit.values()), np.uint64)
            lacking = ~np.bitwise_or.reduce(lut[codes], axis=1)
            for k, mark in enumerate(self.landmarks):
                mask = sum(bit.get(c, 0) for c in set(mark))
                if mask:
                    missing[:, k] += np.bitwise_count(lacking & np.uint64(mask))
        for k, mark in enumerate(self.landmarks):
            need = -int(-SHARED * len(mark) // 1)
            absent = len(mark) - need                     # characters of the landmark that may be missing
            pick = np.flatnonzero(missing[:, k] <= absent)
            if len(pick):
                pick = pick[_common(codes[pick], mark) >= need]
            if len(pick):
                value = kernel([units[i] for i in pick], mark) / self.own[k]
                out[pick, k] = np.where(value >= FLOOR, np.minimum(value, 1.0) ** POWER, 0.0)
        return out

    def learn_words(self, words: set[str]) -> None:
        """Judge the words not seen before; a word that answers no landmark is remembered as None."""
        fresh = [w for w in words if w not in self._known]
        if len(self._known) + len(fresh) > MEMORY_UNITS:
            self._known.clear()
            fresh = list(words)
        units, owner = [], []
        for i, w in enumerate(fresh):
            self._known[w] = None
            for u in units_of(w):
                units.append(u)
                owner.append(i)
        for lo in range(0, len(units), 50_000):
            got = self.responses(units[lo:lo + 50_000])
            for r in np.flatnonzero(got.any(axis=1)).tolist():
                w = fresh[owner[lo + r]]
                old = self._known[w]
                self._known[w] = got[r] if old is None else np.maximum(old, got[r])

    def sentences(self, text: str) -> tuple[np.ndarray, int]:
        """Responses of the sentences that answer any landmark, and the number of all sentences."""
        rows, n = [], 0
        answers = self._known.get
        for s in _SENTENCE.split(text.lower()):
            n += 1
            hits = [a for w in words_of(s) if (a := answers(w)) is not None]
            if hits:
                rows.append(np.max(hits, axis=0))
        return (np.array(rows) if rows else np.zeros((0, len(self.landmarks)))), n

    def read(self, texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """Sentence responses and sentence count of every text."""
        nothing = np.zeros((0, len(self.landmarks)))
        out: list[tuple[np.ndarray, int]] = []
        for lo in range(0, len(texts), 256):
            part = texts[lo:lo + 256]
            bags = [set(words_of(t.lower())) for t in part]
            self.learn_words(set().union(*bags))
            answers = self._known.get
            for text, bag in zip(part, bags, strict=True):
                out.append(self.sentences(text) if any(answers(w) is not None for w in bag) else (nothing, 1))
        return out

    def margins(self, sentences: np.ndarray) -> np.ndarray:
        return sentences @ self.weights + self.bias

    def evidence(self, read: list[tuple[np.ndarray, int]]) -> np.ndarray:
        """Document features: one, best margin over the bias, summed evidence, evidence per sentence (both logarithmic)."""
        out = np.zeros((len(read), 4))
        out[:, 0], out[:, 3] = 1, np.log(SOFT)
        for i, (s, n) in enumerate(read):
            if len(s):
                over = np.maximum(self.margins(s) - self.bias, 0)
                out[i, 1:] = over.max(), np.log1p(over.sum()), np.log(over.sum() / max(n, len(s)) + SOFT)
        return out

    def score(self, texts: list[str]) -> list[float]:
        if self.constant is not None:
            return [self.constant] * len(texts)
        z = self.evidence(self.read(texts)) @ self.logistic
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).tolist()


def _distinct(words: list[set[str]]) -> list[int]:
    """Documents left when near copies are counted once: words shared with one kept, of all words of both, at least ``COPY``.

    ``SKETCH`` smallest hashes, each of another hash function, tell which pairs are worth comparing word by word.
    """
    import zlib

    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
    sketches = np.zeros((len(words), SKETCH), np.uint64)
    for i, w in enumerate(words):
        if w:
            hashes = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in w], np.uint64) + np.uint64(1)
            mixed = hashes[:, None] * factors
            sketches[i] = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)).min(axis=0)
    out: list[int] = []
    for i, w in enumerate(words):
        alike = (sketches[out] == sketches[i]).mean(axis=1) >= COPY - 0.25 if out else []
        if not any(len(w & words[k]) >= COPY * len(w | words[k]) for k in np.array(out)[alike]):
            out.append(i)
    return out


def _grams(unit: str, lengths: tuple[int, int]) -> set[str]:
    return {unit[i:i + k] for k in range(lengths[0], lengths[1] + 1) for i in range(len(unit) - k + 1)}


def _density(words: Counter, lengths: tuple[int, int], around: set[str] | None = None) -> Counter:
    """Occurrences of the character sequences of ``words``; with ``around``, of those that hold one of these."""
    out: Counter = Counter()
    for u, n in words.items():
        if around is None:
            out.update(dict.fromkeys(_grams(u, lengths), n))
        elif _grams(u, SEED_GRAM) & around:
            out.update({g: n for g in _grams(u, lengths) if _grams(g, SEED_GRAM) & around})
    return out


def choose_landmarks(toxic: list[str], clean: list[str], most: int = MAX_LANDMARKS) -> list[str]:
    """Character sequences at least ``MIN_PURITY`` of whose density lies in toxic documents.

    Near copies count once. Sequences are taken by the occurrences in toxic documents that no earlier one
    explains, less a penalty on occurrences in clean ones; of nearly equal ones the longest is taken.
    """
    bags = [Counter(u for w in words_of(t.lower()) for u in units_of(w)) for t in toxic]
    bags = [bags[i] for i in _distinct([set(b) for b in bags])]
    calm: Counter = Counter(u for t in clean for w in words_of(t.lower()) for u in units_of(w))
    bad: Counter = Counter()
    for b in bags:
        bad.update(b)
    least = max(4, round(MIN_SUPPORT * len(bags)))
    odds = max(bad.total(), 1) / max(calm.total(), 1)

    def pure(hits: int, others: int, limit: float) -> bool:
        return hits >= limit * (hits + odds * others)

    there, elsewhere = _density(bad, SEED_GRAM), _density(calm, SEED_GRAM)
    seeds = {g for g, n in there.items() if n >= least and pure(n, elsewhere[g], MIN_PURITY - 0.1)}
    there, elsewhere = _density(bad, GRAM, seeds), _density(calm, GRAM, seeds)
    ranked = {g for g, n in there.items() if n >= least and pure(n, elsewhere[g], MIN_PURITY)}
    holders: dict[str, list[str]] = {g: [] for g in ranked}
    for u in bad:
        for g in _grams(u, GRAM) & ranked:
            holders[g].append(u)
    documents: Counter = Counter()
    for b in bags:
        documents.update({g for u in b for g in _grams(u, GRAM) & ranked})
    cost = {g: PENALTY * odds * elsewhere[g] for g in ranked}
    left = {g: there[g] for g in ranked if documents[g] >= least}
    chosen: list[str] = []
    spent: set[str] = set()
    while left and len(chosen) < most:
        top = max(left[g] - cost[g] for g in left)
        if top < least:
            break
        best = max((g for g in left if left[g] - cost[g] >= NEARLY * top), key=lambda g: (len(g), left[g], g))
        chosen.append(best)
        spent.update(holders[best])
        touched = {u for u in holders[best]}
        left = {g: sum(bad[u] for u in holders[g] if u not in spent) if touched & set(holders[g]) else n
                for g, n in left.items() if g != best}
    return chosen


def _hinge(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine by accelerated full-batch descent on the class-balanced squared hinge loss."""
    n, m = x.shape
    w, b = np.zeros(m), 0.0
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    rate = 1.0 / (1 + 2 * c * (1 + np.linalg.norm(x, 2) ** 2 * share.max()))
    vw, vb = w, b
    for k in range(steps):                                  # accelerated gradient steps
        slack = np.maximum(0, 1 - y * (x @ vw + vb)) * share * y
        nw = vw - rate * (vw / m - 2 * c * (x.T @ slack))
        nb = vb + rate * 2 * c * slack.sum()
        mix = k / (k + 3)
        vw, vb = nw + mix * (nw - w), nb + mix * (nb - b)
        w, b = nw, nb
    return w, b


def fit(toxic: list[str], clean: list[str]) -> Model:
    """Train on whole texts of both classes."""
    marks = choose_landmarks(toxic, clean) if toxic and clean else []
    if not marks:
        n = len(toxic) + len(clean)
        return Model([], np.zeros(0), np.zeros(0), 0.0, constant=len(toxic) / n if n else 0.0)
    own = np.array([kernel([m], m)[0] for m in marks])
    gram = (np.stack([kernel(marks, m) for m in marks]) / np.sqrt(np.outer(own, own))) ** POWER
    lam, vec = np.linalg.eigh((gram + gram.T) / 2)
    root = vec @ np.diag(1 / np.sqrt(np.maximum(lam, 1e-3))) @ vec.T
    model = Model(marks, own, np.ones(len(marks)), 0.0)
    read_toxic, read_clean = model.read(toxic), model.read(clean)
    found = [s for s, _ in read_toxic if len(s)]
    calm = [s for s, _ in read_clean if len(s)]
    negative = np.concatenate([*calm, np.zeros((max(1, len(clean) - len(calm)), len(marks)))])
    gapped = [m[:i] + "\x01" + m[i:] for m in marks for i in range(2, len(m) - 1)]
    extra = model.responses(gapped)
    extra = extra[extra.any(axis=1)]
    for _ in range(ROUNDS if found else 0):
        witness = np.stack([s[np.argmax(model.margins(s))] for s in found])
        x = np.concatenate([witness, extra, negative]) @ root
        y = np.concatenate([np.ones(len(witness) + len(extra)), -np.ones(len(negative))])
        w, model.bias = _hinge(x, y)
        model.weights = root @ w
    model.logistic = logistic(model.evidence(read_toxic + read_clean),
                              np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))]))
    model._known.clear()
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 100) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps."""
    share = np.full(len(y), 1 / max(len(y), 1))
    beta = np.zeros(x.shape[1])
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(beta))
        beta = beta - 0.5 * np.linalg.solve(hess, x.T @ (share * (p - y)) + penalty @ beta)
    return beta


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int],
                  max_chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """A bounded random sample of labelled rows outside the held-out fold: (text, label).

    At most ``most[c]`` ids of class ``c``, the first by a hash of the id, and only texts of at most
    ``max_chars`` characters, are used. An id with both labels counts for both. Scoring covers all rows.
    """
    picked = None
    for c, n in most.items():
        rows = (labels.where(F.col(label) == c).where(~held_out()).select("doc_id").dropDuplicates(["doc_id"])
                .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(n).withColumn("y", F.lit(c)))
        picked = rows if picked is None else picked.unionAll(rows)
    # the sample is bounded by its row counts, so its ids can be broadcast to the scan
    rows = (docs.select("doc_id", "text").where(F.length("text") <= max_chars)
            .join(F.broadcast(picked), "doc_id").select("text", "y", "doc_id"))
    got = rows.orderBy("doc_id", "text").limit(sum(most.values())).collect()
    return [(r.text or "", r.y) for r in got]


SCORE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def scored(docs: DataFrame, model) -> DataFrame:
    """doc_id and score of every row, by a broadcast model with a ``score(texts)`` method."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.score(strings(b.column(1)))
        return pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(score, pa.float64())],
                                          names=SCORE.names)

    return map_columns(docs.select("doc_id", "text"), run, SCORE)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = training_rows(docs, table(spark, sf_dir, "labels"), "toxic", {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN})
    model = fit([t for t, y in rows if y], [t for t, y in rows if not y])
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
