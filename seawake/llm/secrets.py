"""Secret scan: three fixed patterns plus sliding-window entropy per character class.

Patterns (leftmost, non-overlapping per kind): ``assign`` (a keyword, a sign, a value), ``access``
(access-key ids) and ``hex`` (long hexadecimal runs); matches that are too short are dropped.

Entropy: candidates are maximal runs of the secret alphabet; ``=`` belongs to a run only as padding at its end.
Allow-listed parts of a run (UUIDs, placeholder words, alphabet or digit sequences) are cut out, and what lies
before and after them is searched on its own. A window of ``WINDOW`` characters slides over each piece; the counts of its
characters, and with them the sum of ``c·log2 c``, change by one character out and one in, so a step costs the same
whatever the window. A window's class is the narrowest (hexadecimal, alphanumeric, base-64) that holds all its characters,
whatever the rest of the run holds. It counts as random when its entropy reaches the limit of its own alphabet and it does not
read like words: at most half of its neighbouring letters and digits are pairs common in words (a quarter of random letter pairs
is), or fewer than ``FEW_PAIRS`` of them; hexadecimal windows need a digit only. Overlapping random windows join; the span is widened to the next separator
(``-``, ``_``, ``/``) on both sides, without end parts that are words, and has the kind ``entropy_<class>`` of its characters.
Base spans always stay; an entropy span inside a base span is not repeated.

All offsets are code points, ends exclusive. Edge cases: null text is the empty text and has no
spans; repeated rows are reported each; the whole text is scanned however long.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seawake.llm.common import map_columns, outside, strings, table

# The base patterns, their kinds in reporting order, and their least lengths.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")          # a maximal run is found from its first character
MIN_ASSIGN, MIN_ACCESS = 6, 20
BASE_KINDS = ("assign", "access", "hex")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# class: its alphabet; narrowest class first
CLASSES = {
    "hex": re.compile(r"[0-9A-Fa-f]+"),
    "alnum": re.compile(r"[A-Za-z0-9]+"),
    "base64": re.compile(r"[A-Za-z0-9+/_=-]+"),
}
KINDS = (*BASE_KINDS, *(f"entropy_{c}" for c in CLASSES))
# Entropy limits in bits per character: hexadecimal, letters of one case with or without digits, all else.
# Fewer than one in a hundred random windows of each alphabet lie below.
HEX_LIMIT, ONE_CASE_LIMIT, MIXED_LIMIT = 2.5, 3.05, 3.5

# Letters that often follow a letter in English, German, French and Spanish words.
_FOLLOWERS = {
    "a": "bcdilmnprstuv", "b": "aeilor", "c": "aehikot", "d": "aeio", "e": "acdelmnprstuvx", "f": "aefior", "g": "aehoru",
    "h": "aeiot", "i": "acdelmnorstv", "j": "eou", "k": "ein", "l": "aeilostuy", "m": "aeiop", "n": "acdegiost",
    "o": "cdflmnprstuw", "p": "aeilopr", "q": "u", "r": "adeimost", "s": "acehiopstu", "t": "aehiorsu", "u": "celnprst",
    "v": "aeio", "w": "aehio", "x": "pt", "y": "os", "z": "eu"}
COMMON = frozenset(x + y for a, after in _FOLLOWERS.items() for b in after
                   for x, y in ((a, b), (a.upper(), b), (a.upper(), b.upper())))
SEPARATORS = "/_-"
PART = re.compile(r"[A-Za-z]*[/_-]")                   # letters up to a separator
FEW_PAIRS = 3                # fewer common pairs than these never make words


def _chain(letters: str) -> str:
    """Pattern of 12 or more successive characters from the first of ``letters`` on."""
    rest = ""
    for c in reversed(letters[12:]):
        rest = f"(?:{c}{rest})?"
    return letters[:12] + rest


_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz" * 2, "0123456789" * 5
ALLOW = re.compile(
    r"(?i)(?<![0-9A-Z])[0-9A-F]{8}(?:-[0-9A-F]{4}){3}-[0-9A-F]{12}(?![0-9A-Z])"     # UUID
    r"|example|placeholder|changeme|"                                                # placeholder
    + "|".join([_chain(_LETTERS[i:i + 26]) for i in range(26)] + [_chain(_DIGITS[i:i + 40]) for i in range(10)]))
NUMBERS = re.compile(r"[0-9+/_=-]+")                                                 # numbers and rules only
DOCUMENTED = ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",)                           # placeholder keys of manuals

Span = tuple[int, int, str]                 # start, end, kind


def _terms(width: int) -> list[float]:
    return [0.0] + [c * math.log2(c) for c in range(1, width + 1)]


def entropies(text: str, width: int = WINDOW) -> list[float]:
    """Shannon entropy (bits per character) of every window, by incremental counts."""
    if len(text) < width:
        return []
    term, counts, total, out = _terms(width), {}, 0.0, []
    for i, ch in enumerate(text):
        if i >= width:
            old = text[i - width]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= width - 1:
            out.append(math.log2(width) - total / width)
    return out


def _class(text: str) -> str:
    return next(c for c, alphabet in CLASSES.items() if alphabet.fullmatch(text))


def _limit(text: str) -> float:
    """Entropy limit of a window, by the alphabet its characters come from."""
    if CLASSES["hex"].fullmatch(text):
        return HEX_LIMIT
    return ONE_CASE_LIMIT if text.isalnum() and text in (text.lower(), text.upper()) else MIXED_LIMIT


def wordy(text: str) -> bool:
    """Whether most neighbouring characters, one of them a letter and the other no sign, are pairs common in words."""
    pairs = [p for i in range(len(text) - 1) if (p := text[i:i + 2]).isalnum() and not p.isdigit()]
    common = sum(p in COMMON for p in pairs)
    return common >= FEW_PAIRS and 2 * common > len(pairs)


def random_window(text: str, bits: float) -> bool:
    if bits < _limit(text) or NUMBERS.fullmatch(text):
        return False
    return not wordy(text) or _class(text) == "hex" and not text.isalpha()


def _widened(run: str, a: int, b: int) -> tuple[int, int]:
    """A span widened to the separators around it, without the end parts that are words."""
    while a and run[a - 1] not in SEPARATORS:
        a -= 1
    while b < len(run) and run[b] not in SEPARATORS:
        b += 1
    while (m := PART.match(run, a, b)) and b - m.end() >= WINDOW and (len(m.group()) == 1 or wordy(m.group())):
        a = m.end()
    while True:
        end = b
        while end > a and run[end - 1] in SEPARATORS:
            end -= 1
        at = end
        while at > a and run[at - 1].isalpha():
            at -= 1
        if at - a <= WINDOW or run[at - 1] not in SEPARATORS or at < end and not wordy(run[at:end]):
            return a, b
        b = at - 1


def base_spans(text: str) -> list[Span]:
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return ordered(spans)


def _pieces(m: re.Match) -> list[tuple[int, str]]:
    """Start and text of the parts of a candidate that are not allow-listed."""
    run, out, at = m.group(), [], 0
    if run in DOCUMENTED:
        return []
    for cut in ALLOW.finditer(run):
        out.append((m.start() + at, run[at:cut.start()]))
        at = cut.end()
    return [*out, (m.start() + at, run[at:])]


def entropy_spans(text: str) -> list[Span]:
    found = []
    for m in CANDIDATE.finditer(text):
        if m.end() - m.start() < WINDOW:
            continue
        for at, run in _pieces(m):
            spans: list[list[int]] = []
            for i, bits in enumerate(entropies(run)):
                if bits >= HEX_LIMIT and random_window(run[i:i + WINDOW], bits):
                    a, b = (i, i + WINDOW) if spans and i < spans[-1][1] else _widened(run, i, i + WINDOW)
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
            for a, b in spans:
                a, b = _widened(run, a, b)
                found.append((at + a, at + b, f"entropy_{_class(run[a:b])}"))
    return found


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(text: str) -> list[Span]:
    """All spans of a text: base ones, and entropy ones outside them."""
    base = base_spans(text)
    return ordered(base + outside(entropy_spans(text), base))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redact(text: str, mask: str = "[SECRET]") -> str:
    """The text with every secret replaced by ``mask`` (overlapping spans merge; an assignment keeps its keyword)."""
    cuts: list[list[int]] = []
    for a, b, kind in scan(text):
        if kind == "assign":
            a = ASSIGN.match(text, a).start(2)
        cuts.append([a, b])
    cuts.sort()
    merged: list[list[int]] = []
    for a, b in cuts:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out += [text[at:a], mask]
        at = b
    return "".join(out) + text[at:] if out else text


SPANS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_assign", T.LongType()),
    T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def findings(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = {k: [] for k in BASE_KINDS}, [], []
        for text in strings(b.column(1)):
            found = scan(text)
            base = [s for s in found if s[2] in BASE_KINDS]
            for k in BASE_KINDS:
                counts[k].append(sum(s[2] == k for s in base))
            digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            spans.append(written(found))
        return pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.int64()), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS],
             pa.array(digests, pa.string()), pa.array(spans, pa.string())], names=SPANS.names)

    return map_columns(docs.select("doc_id", "text"), run, SPANS)


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with secrets masked in ``text`` and ``n_chars`` (if there) recounted; null texts stay null."""
    at = docs.columns.index("text")
    n = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        old = b.column(at).to_pylist()
        new = [x and redact(x) for x in old]
        columns = list(b.columns)
        columns[at] = pa.array(new, b.schema.field(at).type)
        if n is not None:
            counts = [c if x == y else len(y) for c, x, y in zip(b.column(n).to_pylist(), old, new, strict=True)]
            columns[n] = pa.array(counts, b.schema.field(n).type)
        return pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return map_columns(docs, run, docs.schema)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(table(spark, sf_dir, "documents"))
