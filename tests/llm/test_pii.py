import hashlib
import random
import re
import time

import pytest

from seawake.llm import pii
from tests.llm.conftest import frame, sample_texts

IBANS = ["DE89370400440532013000", "GB82WEST12345698765432", "FR1420041010050500013M02606", "ES9121000418450200051332",
         "NO9386011117947", "MT84MALT011000012345MTLCAST001S"]
CARDS = ["4111111111111111", "5500 0000 0000 0004", "3400-0000-0000-009", "6011000000000004"]


def slow_base(text):
    """The four patterns as given, searched one after the other."""
    out = []
    for k, (name, pattern, ok) in enumerate((
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and sum(
                sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15))):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if ok(m.group())]
    return [x for _, _, x in sorted(out)]


def with_check(rng, n):
    """A number of ``n`` digits that passes Luhn's test."""
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + c for c in "0123456789" if pii.luhn(head + c))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    pieces = ["a", "b.c", "@", "@", ".", "-", "+", "+1", " ", "  ", "12", "255", "256", "1", "0", "(", ")", "é", "٣", "007",
              "4111111111111111", "x@y.z", "1.2.3.4", "\n", "%", "_"]
    texts = [None, "", "a@b.c@d.e", "a@@b.c", "@b.c", "a@b", "a@b.", "a@b..c", "é@b.c d@e-.f-", "1.2.3.4.5.6.7.8", "1.2.3",
             "0001.2.3.4 1.2.3.256", "+1 (487) 555-7209", "+12", "+1 2 3 4 5 6 7 8 ", "😀 x@y.zz 😀", *CARDS, *sample_texts()]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 16))) for _ in range(600)]
    texts += [" ".join(with_check(rng, n) for n in range(11, 21))]
    got = {r.doc_id: r for r in pii.findings(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = slow_base(t or "")
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in pii.BASE_KINDS]
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert (r.scores.count(",") == r.spans.count(",")) and (r.spans == "") == (r.scores == "")


def test_checksums():
    assert all(pii.mod97(x) for x in IBANS)
    rng = random.Random(1)
    for x in IBANS:                                   # every change of one digit is noticed
        for i in (k for k, c in enumerate(x) if c.isdigit()):
            assert not pii.mod97(x[:i] + str((int(x[i]) + rng.randint(1, 9)) % 10) + x[i + 1:])
        letters = "".join(str(int(c, 36)) for c in x[4:] + x[:4])
        assert int(letters) % 97 == 1
    for card in CARDS:
        assert pii.luhn(pii.digits(card))
        assert not pii.luhn(pii.digits(card)[:-1] + str((int(card[-1]) + 1) % 10))
    assert pii.mod11_10("86095742719") and not pii.mod11_10("86095742718")
    assert not pii.small_parts("9" * 6000 + ".1.1.1") and pii.small_parts("0" * 6000 + "1.255.0.1")


@pytest.mark.parametrize("text, kinds", [
    ("my IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", ["iban"]),
    ("DE89370400440532013000", ["iban"]),
    ("DE89370400440532013001", []),
    ("xDE89370400440532013000", []),
    ("GB82 WEST 1234 5698 7654 32.", ["iban"]),
    ("NIR 2 61 08 14 168 026 34", ["nir"]), ("NIR 2 61 08 14 168 026 33", []),
    ("185072A12345665", ["nir"]), ("185072C12345665", []),
    ("2 55 08 14 168 025 38", ["card"]),             # passes Luhn's test too: the base span stays alone
    ("DNI 12345678Z", ["dni"]), ("12345678A", []), ("X1234567L", ["dni"]),
    ("order 12345678Z", []),                         # the checksum alone is weak, and a word speaks against it
    ("SSN 123-45-6789", ["ssn"]), ("123-45-6789", []), ("SSN 666-45-6789", []),
    ("part number 123-45-6789", []),
    ("call 415-555-0132 now", ["phone_local"]), ("(415) 555-0132", []), ("Tel. (415) 555-0132", ["phone_local"]),
    ("telescopes 415-555-0132", []),                 # whole words only
    ("Steuer-ID 86 095 742 719", ["steuer_id"]), ("86 095 742 719", []),
    ("phone +1 (487) 555-7209", ["phone"]),          # the local form inside it is not repeated
])
def test_added_spans_need_a_checksum_or_a_word(text, kinds):
    assert [s[2] for s in pii.scan(text)] == kinds


def test_context_moves_the_score_and_base_spans_stay():
    def card(before):
        return next(s[3] for s in pii.scan(f"{before} 4111111111111111") if s[2] == "card")

    assert card("order number") < card("") < card("credit card") == card("credit card order") <= 1
    far = "credit " + "x " * pii.BEFORE + " 4111111111111111"
    assert pii.scan(far)[0][3] == card("")


def test_overlapping_added_spans_keep_the_better():
    text = "bank DE89 3704 0044 0532 0130 00"
    assert [pii.written([s]) for s in pii.scan(text)] == ["iban:5:32"]


def test_planted_ibans_are_found_and_random_ones_left():
    rng = random.Random(9)
    found = alone = 0
    for _ in range(400):
        body = "".join(rng.choice("0123456789") for _ in range(18))
        good = next(f"DE{k:02d}{body}" for k in range(2, 99) if pii.mod97(f"DE{k:02d}{body}"))
        shown = " ".join(good[i:i + 4] for i in range(0, 22, 4)) if rng.random() < 0.5 else good
        found += [s[2] for s in pii.scan(f"wort {shown} wort") if s[2] == "iban"] == ["iban"]
        alone += not any(s[2] == "iban" for s in pii.scan(f"DE{rng.randint(2, 98):02d}{body}"))
    assert found == 400 and alone >= 390


def test_redaction_keeps_everything_else(spark):
    texts = ["write a@b.cd or +1 (487) 555-7209, thanks", None, "", "plain", "é 1.2.3.4 é"]
    rows = pii.mask_personal(frame(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["write [EMAIL] or [PHONE], thanks", None, "", "plain", "é [IP] é"]
    assert all(r["key"] == "k" and r["group"] == 1 for r in rows)


def test_long_texts_take_linear_time():
    for unit in ("a", "1", "1.", "+1 ", "a@", "1 ", "A1", "é", "a@b.c ", "1.2.3.4 ", "4111111111111111 ", "+", "@"):
        took = []
        for n in (60_000, 240_000):
            text = unit * (n // len(unit))
            began = time.process_time()
            pii.scan(text)
            took.append(time.process_time() - began)
        assert took[1] < 10 * took[0] + 0.3, unit


def test_awkward_tables(spark, docs, no_docs):
    assert pii.findings(no_docs).count() == 0
    assert pii.findings(docs).count() == docs.count()
    twice = pii.findings(frame(spark, ["a@b.cd", "a@b.cd"], [None, 7])).collect()
    assert len(twice) == 2 and len({r.spans for r in twice}) == 1
