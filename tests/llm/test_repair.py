import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from seawake.llm import repair
from seawake.llm.common import prepare
from tests._compare import compare, duck
from tests._paths import SF_MID, SF_SMALL

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType()), T.StructField("audit", T.StringType()), T.StructField("known", T.IntegerType())])


def frame(spark, rows):
    return prepare(spark).createDataFrame([(*r, "other", 1) for r in rows], ROWS)


def slow_best(symbols):
    """All edit scripts, extended row by row; every (cost, audit) of a state is kept, so nothing is assumed of ties."""
    def inserted(ways):
        out = set(ways)
        for _ in range(3):
            out |= {(s + "ua"[s[-1:] == "u"], c + 3, a + "I") for s, c, a in out if len(s) < len(symbols) + 5}
        least = {}
        for s, c, a in out:                          # a state is the last role
            least[s[-1:]] = min(least.get(s[-1:], 99999), c)
        return {(s, c, a) for s, c, a in out if c <= least[s[-1:]] + 6}

    ways = {("", 0, "")}
    for role, gone, cut in symbols:
        new = set()
        for s, c, a in inserted(ways):
            new.add((s, c + 4, a + "D"))
            if not gone:
                nxt = "ua"[s[-1:] == "u"]
                new.add((s + nxt, c + 3 * cut + (0 if role == nxt else 3), a + ("K" if role == nxt else "R")))
                if role == "s" and s == "":
                    new.add((s + "s", c + 3 * cut, a + "K"))
        ways = new
    return min((c, a) for s, c, a in inserted(ways) if re.fullmatch("(s?(ua)+)?", s))


def fold(symbols, rules=()):
    known = repair.matrices(tuple(rules))
    row = [(0, repair.EMPTY), None, None, None]
    for s in symbols:
        row = repair.times(row, known[s])
    last = repair.times(row, repair.inserts())
    cost, audit = repair.better(last[0], last[3])
    return cost, str(audit)


def spelled(symbol):
    return ("x", True, False) if symbol == repair.GONE else ("suax"[symbol // 2], False, symbol % 2 == 1)


def test_product_of_matrices_equals_all_edit_scripts():
    for n in range(4):
        for seq in itertools.product(range(9), repeat=n):
            assert fold(seq) == slow_best([spelled(s) for s in seq]), seq
    rng = random.Random(3)
    for _ in range(60):
        seq = [rng.choice([0, 2, 2, 4, 4, 3, 6, 8]) for _ in range(rng.randint(4, 7))]
        assert fold(seq) == slow_best([spelled(s) for s in seq]), seq


def test_rules_change_nothing(spark):
    rng = random.Random(4)
    seqs = [bytes(rng.choice([2, 4, 2, 4, 3, 8, 0]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    seqs += [bytes([2, 4] * 500), bytes([8] * 333), bytes([2] * 100)]
    table = prepare(spark).createDataFrame([(bytearray(s), 1 + len(s) % 3) for s in seqs], "symbols binary, weight long")
    rules = repair.re_pair(table, max_rules=40)
    assert 30 < len(rules) <= 40

    def expand(s):
        if s < repair.FIRST_RULE:
            return [s]
        a, b = rules[s - repair.FIRST_RULE]
        return expand(a) + expand(b)

    short = repair.shortened(seqs, rules)
    for s, x in zip(seqs, short, strict=True):
        assert [t for k in x.tolist() for t in expand(k)] == list(s)
        if len(s) < 70:
            assert fold(x.tolist(), rules) == fold(s)
    assert sum(map(len, short)) < sum(map(len, seqs)) / 2
    assert fold(short[200].tolist(), rules) == (0, "K" * 1000)
    assert repair.re_pair(table.limit(0)) == ()


def test_first_round_takes_the_most_frequent_pairs(spark):
    seqs = [(bytearray([2, 4, 2, 4, 3]), 5), (bytearray([8, 8, 8]), 2), (bytearray([6]), 100), (bytearray([0, 1]), 1)]
    table = prepare(spark).createDataFrame(seqs, "symbols binary, weight long")
    got = {(r.a, r.b): r.n for r in repair.pair_counts(table, ()).collect()}
    assert got == {(2, 4): 10, (4, 2): 5, (4, 3): 5, (8, 8): 4, (0, 1): 1}
    rules = repair.re_pair(table)
    assert rules[0] == (2, 4) and (4, 2) not in rules and (0, 1) not in rules
    assert set(rules[1:2]) == {(8, 8)}


def test_pairs_of_one_symbol_are_replaced_from_the_left():
    x = np.array([5, 5, 5, 1, 5, 5, 5, 5, -1, 5])
    assert repair.replaced(x, 5, 5, 9).tolist() == [9, 5, 1, 9, 9, -1, 5]


def test_ropes_compare_like_texts():
    rng = random.Random(8)

    def rope(text):
        if len(text) < 2 or rng.random() < 0.3:
            return repair.Rope(text)
        k = rng.randint(0, len(text))
        return rope(text[:k]) + rope(text[k:])

    texts = ["".join(rng.choice("DIKR") for _ in range(rng.randint(0, 12))) for _ in range(120)]
    for a, b in itertools.product(texts[:60], texts):
        x, y = rope(a), rope(b)
        assert (x < y) == (a < b) and str(x) == a and (x.hash == y.hash and x.size == y.size) == (a == b)


def slow_repair(given):
    """The contract, conversation by conversation, with ``slow_best``'s scripts."""
    out = {}
    for conv in {r[0] for r in given}:
        rows = []
        for c, turn, role, text in (r for r in given if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if hit == 0:
                continue
            role, text = "user" if hit == 4 else role, "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            rows += [(turn, role, text)] * (2 if hit == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults, symbols = set(), [], []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen else
                     "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            faults.append(fault)
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {r[0] for r in rows if r[0] is not None}
        cost, audit = slow_best(symbols)
        body, k, roles = [], 0, ""
        for e in audit:
            role, text = ("", "") if e == "I" else rows[k][1:]
            k += e != "I"
            if e != "D":
                new = role if e == "K" else {"u": "assistant"}.get(roles[-1:], "user")
                roles += new[:1]
                body.append(f"{new}:{text}")
        assert re.fullmatch("(s?(ua)+)?", roles)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (
            "blank", "duplicate", "truncated")], sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost, audit, hashlib.sha256("\n".join(body).encode()).hexdigest())
    return out


def random_rows(seed, convs=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "student", " "]
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "é?", "Yes.", "a.\n", "...", "x" * 300]
    rows = []
    for c in [*range(convs), None]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts)))
    return rows + [(5, 0, "user", "Yes.")] * 3 + [(convs + 3, k, None, None) for k in range(3)]


@pytest.mark.parametrize("piece", [4096, 2])
def test_repair_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    for seed in (1, 2):
        given = random_rows(seed)
        table = frame(spark, given)
        got = {r.conv_id: tuple(r)[1:] for r in repair.repair(repair.damaged(table), table).collect()}
        assert got == slow_repair(given)


def test_one_long_conversation_is_cut_over_tasks(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for t in range(3000)] + [(8, 0, "user", "Hi.")]
    rows += [(9, 1, "user", "Same.")] * 5000
    table = frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")        # else this little data is one partition
    try:
        parts = repair.pieces(table).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(len(p.symbols) for p in parts) == len(rows)
    assert len([p for p in parts if p.conv_id == 7]) > 1            # several range partitions hold it
    got = {r.conv_id: r for r in repair.repair(table, table).collect()}
    assert got[7].audit == "K" * 3000 and got[7].cost == 0 and got[7].gaps == 0
    assert got[8].audit == "KI" and got[8].cost == 3
    assert got[9].duplicate == 4999 and got[9].audit == "K" + "D" * 4999 + "I" and got[9].cost == 19_999


def test_conversations_without_rows(spark):
    table = frame(spark, [(c, t, "user", "Hi.") for c in range(40) for t in range(1)])
    gone = {c for c in range(40) if zlib.crc32(f"{c}:0".encode()) % 20 == 0}
    assert gone
    got = {r.conv_id: r for r in repair.repair(repair.damaged(table), table).collect()}
    assert set(got) == set(range(40))
    for c in gone:
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = frame(spark, [])
    assert repair.repair(repair.damaged(empty), empty).count() == 0


def test_query_equals_sql(spark):
    for sf in (SF_SMALL, SF_MID):
        assert compare(repair.op11_repair(spark, sf), duck(sf), repair.ORACLE) > 0
