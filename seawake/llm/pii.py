"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their scores.

**Base kinds** (leftmost, non-overlapping per kind; a match that fails its test is dropped and not tried again): ``email``;
``ip`` with parts of at most 255; ``card`` of 12 to 19 digits that pass Luhn's test; ``phone`` of 9 to 15 digits after a plus
sign. They are always reported.

**Added kinds**: ``iban`` (length of its country, ISO 7064 mod 97-10), ``nir`` (French insurance number, key mod 97), ``dni``
(Spanish identity number, letter mod 23), ``steuer_id`` (German tax number, ISO 7064 mod 11,10), ``ssn`` (ranges of valid
parts) and ``phone_local`` (ten digits in the usual grouping). One is reported when its score reaches ``LEAST_SCORE``.

**Score** of a span, 0 to 1: the prior of its pattern, plus ``CONFIRMED`` when a checksum of its kind passed (a failing one drops the
span), plus ``NEAR`` when a word of its kind stands within ``BEFORE`` characters before or ``AFTER`` behind it, minus ``AGAINST``
when a word that names other numbers (order, version, ...) does and none of its own. So numbers whose checksum is weak or absent are
reported only beside a word that says what they are.

An added span inside a base span is not repeated; of two overlapping added spans the better score stays, then the
longer, then the first. Every search is linear in the text: patterns either consume what they
read or start only where a run of their characters starts.

All offsets are code points, ends exclusive. Edge cases: null text is the empty text and has no
spans; repeated rows and null ids are reported each; the whole text is scanned however long; an
empty table gives an empty result; other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seawake.llm.common import map_columns, outside, strings, table

BASE_KINDS = ("email", "ip", "card", "phone")
LEAST_SCORE = 0.6
CONFIRMED, NEAR, AGAINST = 0.3, 0.25, 0.3
BEFORE, AFTER = 48, 24

# The base patterns.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")     # a match always starts where a run of digits starts
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24,
    "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20}
# Fixed value: the control letters of the Spanish identity number, by remainder.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
# Departments with a letter and the digits that stand for them in the French insurance number.
CORSICA = {"2A": "19", "2B": "18"}

_DIGITS = re.compile("[^0-9]")
_WORD = re.compile(r"[^\W\d_]+")

Span = tuple[int, int, str, float]          # start, end, kind, score


def digits(s: str) -> str:
    return _DIGITS.sub("", s)


def luhn(number: str) -> bool:
    """Luhn's checksum: every second digit from the right doubled, digits of the results summed, divisible by ten."""
    doubled = sum(sum(divmod(2 * int(c), 10)) for c in number[-2::-2])
    return (doubled + sum(int(c) for c in number[-1::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 of an IBAN without blanks: first four characters last, letters as 10 to 35."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def mod11_10(number: str) -> bool:
    """ISO 7064 mod 11,10: the last digit is the check digit."""
    p = 10
    for c in number[:-1]:
        p = (p + int(c)) % 10 or 10
        p = 2 * p % 11
    return (p + int(number[-1])) % 10 == 1


def small_parts(ip: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in ip.split("."))


def _iban(m: re.Match) -> int | None:
    """End of the IBAN that begins at the match, if its length and checksum are right."""
    want = IBAN_LENGTHS.get(m.group()[:2])
    at, got = m.start(), ""
    while want and len(got) < want:
        if at >= m.end():
            return None
        if m.string[at] != " ":
            got += m.string[at]
        at += 1
    follows = m.string[at:at + 1]
    return at if want and mod97(got) and not (follows.isascii() and follows.isalnum()) else None


def _nir(m: re.Match) -> int | None:
    s = m.group().replace(" ", "")
    month, department = int(s[3:5]), CORSICA.get(s[5:7], s[5:7])
    if not department.isdigit() or not (1 <= month <= 12 or month >= 20):
        return None
    return m.end() if 97 - int(s[:5] + department + s[7:13]) % 97 == int(s[13:]) else None


def _dni(m: re.Match) -> int | None:
    s = m.group().replace("-", "")
    number = int(s[:-1].translate(str.maketrans("XYZ", "012")))
    return m.end() if DNI_LETTERS[number % 23] == s[-1] else None


@dataclass(frozen=True)
class Kind:
    """``proves`` gives the end of a confirmed match or None; without it a pattern has no checksum."""

    prior: float
    near: frozenset[str]
    pattern: re.Pattern | None = None
    proves: Callable[[re.Match], int | None] | None = field(default=None)
    checked: bool = False


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


_PHONE_WORDS = _words("phone telephone tel mobile cell call fax contact whatsapp telefon handy mobil anruf rufnummer "
                      "téléphone portable appel appelez joindre teléfono telefono móvil movil llamar llame celular")
# priors by how seldom ordinary text has the form; English, German, French and Spanish words that announce the kind
KINDS: dict[str, Kind] = {
    "email": Kind(0.8, _words("email mail contact write mailto adresse correo courriel kontakt")),
    "ip": Kind(0.5, _words("ip address server host login client adresse dirección direccion serveur")),
    "card": Kind(0.4, _words("card credit debit visa mastercard amex payment karte kreditkarte zahlung carte crédit paiement "
                             "tarjeta crédito pago cvv expires"), checked=True),
    "phone": Kind(0.6, _PHONE_WORDS),
    "iban": Kind(0.5, _words("iban bank account konto bankverbindung compte banque cuenta banco transfer überweisung virement"),
                 re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"), _iban, True),
    "nir": Kind(0.4, _words("nir sécurité sociale assuré immatriculation insee"),
                re.compile(r"(?<![A-Za-z0-9])[12] ?[0-9]{2} ?[0-9]{2} ?[0-9][0-9AB] ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}"
                           r"(?![A-Za-z0-9])"), _nir, True),
    "dni": Kind(0.3, _words("dni nie nif identidad documento identificación"),
                re.compile(r"(?<![A-Za-z0-9])(?:[XYZ][0-9]{7}|[0-9]{8})-?[A-Z](?![A-Za-z0-9])"), _dni, True),
    "steuer_id": Kind(0.2, _words("steuer steuernummer steueridentifikationsnummer identifikationsnummer idnr tin"),
                      re.compile(r"(?<![A-Za-z0-9])[1-9][0-9] ?[0-9]{3} ?[0-9]{3} ?[0-9]{3}(?![A-Za-z0-9])"),
                      lambda m: m.end() if mod11_10(digits(m.group())) else None, True),
    "ssn": Kind(0.4, _words("ssn social security taxpayer"),
                re.compile(r"(?<![A-Za-z0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![A-Za-z0-9-])")),
    "phone_local": Kind(0.35, _PHONE_WORDS,
                        re.compile(r"(?<![A-Za-z0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9-])")),
}
ORDER = {name: i for i, name in enumerate(KINDS)}
# Words that announce numbers of other kinds.
OTHER_NUMBERS = _words("version release build order invoice item product part serial isbn issn page chapter section line tracking "
                       "ticket reference bestellung rechnung artikel seite kapitel commande facture article référence "
                       "pedido factura artículo página capítulo example sample test")


def nearby(text: str, start: int, end: int) -> set[str]:
    """Whole words in the windows before and behind a span, lower-cased."""
    lo, hi = max(0, start - BEFORE), min(len(text), end + AFTER)
    found = [m for m in _WORD.finditer(text, lo, start) if not (m.start() == lo > 0 and text[lo - 1].isalpha())]
    found += [m for m in _WORD.finditer(text, end, hi) if not (m.end() == hi < len(text) and text[hi].isalpha())]
    return {m.group().lower() for m in found}


def score(text: str, start: int, end: int, kind: str) -> float:
    k, words = KINDS[kind], nearby(text, start, end)
    near = NEAR if words & k.near else -AGAINST if words & OTHER_NUMBERS else 0.0
    return round(min(1.0, max(0.0, k.prior + CONFIRMED * k.checked + near)), 2)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from their at signs: each takes the whole run before it, up to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(a, b, "email") for a, b in _emails(text)]
    spans += [(*m.span(), "ip") for m in IP.finditer(text) if small_parts(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(number := digits(m.group())) <= 19 and luhn(number):
            spans.append((*m.span(), "card"))
    spans += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(spans, key=lambda s: (s[0], ORDER[s[2]]))


def added_spans(text: str) -> list[Span]:
    """Confirmed spans of the added kinds with a sufficient score; of overlapping ones the better."""
    found = []
    for name, kind in KINDS.items():
        for m in kind.pattern.finditer(text) if kind.pattern else ():
            end = kind.proves(m) if kind.proves else m.end()
            if end is not None and (s := score(text, m.start(), end, name)) >= LEAST_SCORE:
                found.append((m.start(), end, name, s))
    kept: list[Span] = []
    for s in sorted(found, key=lambda s: (s[0], ORDER[s[2]])):
        if not kept or s[0] >= kept[-1][1]:
            kept.append(s)
        elif (s[3], s[1] - s[0]) > (kept[-1][3], kept[-1][1] - kept[-1][0]):
            kept[-1] = s
    return kept


def scan(text: str) -> list[Span]:
    """All spans of a text with their scores, by start, then kind."""
    if not any(c in text for c in "@0123456789"):
        return []
    base = base_spans(text)
    scored = [(a, b, kind, score(text, a, b, kind)) for a, b, kind in base]
    return sorted(scored + outside(added_spans(text), base), key=lambda s: (s[0], ORDER[s[2]]))


def written(spans: list) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


SPANS = T.StructType([
    T.StructField("doc_id", T.LongType()), *[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType()), T.StructField("scores", T.StringType())])


def findings(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, all spans and their scores of every row; nothing is shuffled."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(b.column(0).cast(pa.int64()).to_pylist(), strings(b.column(1)), strict=True):
            found = scan(text)
            base = [s for s in found if s[2] in BASE_KINDS]
            rows.append((doc_id, *[sum(s[2] == k for s in base) for k in BASE_KINDS],
                         hashlib.sha256(written(base).encode()).hexdigest(), written(found), len(found) - len(base),
                         ",".join(f"{s[3]:.2f}" for s in found)))
        kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=SPANS.names)

    return map_columns(docs.select("doc_id", "text"), run, SPANS)


def redact(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans merge under the first one's name."""
    out, at = [], 0
    for a, b, kind, _ in scan(text):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def mask_personal(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with personal data masked in ``text``; null texts stay null, other columns are untouched."""
    at = docs.columns.index("text")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(b.columns)
        columns[at] = pa.array([x and redact(x) for x in b.column(at).to_pylist()], b.schema.field(at).type)
        return pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return map_columns(docs, run, docs.schema)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(table(spark, sf_dir, "documents"))
