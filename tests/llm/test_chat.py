import pyarrow as pa
import hashlib
import random

import pytest

from seawake.llm import chat
from seawake.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string, piece string, position long"
PARTS = ["[", "/", "INST]", "<", "s>", ">", "|", "\\", "<SYS>>", "</SYS>>", " ", "a", "end|>", "|> ", "\n", "[INST] ", " </s>"]


def test_every_turn_survives_the_round_trip():
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))
        assert chat.unescape(chat.escape(t)) == t
        for role in ("user", "assistant", "system", "tool", "", "odd|> role [INST]"):
            written, lo, hi = chat.render(role, t)
            got = chat.read_turn(written)
            assert got[:2] == (role, t) and got[4] == len(written)
            assert chat.unescape(written[lo:hi]) == t
            assert not any(c in written[lo:hi] for c in ("[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<|"))


def test_malformed_text_is_refused():
    for bad in ("[INST] never closed", "[INST] a </s>", "x", "<|tool|> a </s>", " a[/INST]"):
        with pytest.raises(chat.Malformed):
            chat.read_turn(bad)


def conversations(spark, rows):
    return prepare(spark).createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest()
        out.append((conv, len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def test_digests_equal_brute_force(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]),
             rng.choice([None, "", "".join(rng.choice(PARTS) for _ in range(12)), "text é😀"]))
            for c in [*range(30), None, -5] for t in range(rng.randint(1, 9))]
    rows += [(500, 0, "user", "same"), (500, 0, "user", "same"), (500, None, "assistant", "first"),
             (501, 3, "assistant", "long " * 50_000)]
    rows += [(600, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    got = chat.read_back(chat.formatted(conversations(spark, rows))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)


def test_pieces_make_up_the_conversation_and_the_mask(spark):
    rows = [(1, 0, "system", "be </s> kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes [/INST]"), (1, 3, "assistant", None)]
    got = sorted(chat.formatted(conversations(spark, rows)).collect(), key=lambda r: r.position)
    whole = "".join(r.piece for r in got)
    assert whole == "<s><<SYS>> be <\\/s> kind <</SYS>>[INST] hi [/INST] yes [\\/INST] </s>  </s>"
    assert [whole[r.loss_start:r.loss_end] for r in got if r.loss_start is not None] == ["yes [\\/INST]", ""]
    assert [r.piece_start for r in got] == [0, *(sum(len(x.piece) for x in got[:k]) for k in range(1, 4))]


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(conversations(spark, []))).count() == 0


def test_long_turns_come_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(chat, "BATCH_BYTES", 1000)
    rows = [(1, k, "user", "x" * 400) for k in range(10)]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = spark.createDataFrame(rows, "a long, b long, c string, d string").schema
    sizes = [b.num_rows for b in chat._batches(iter(rows), schema, kinds)]
    assert sizes == [3, 3, 3, 1]
