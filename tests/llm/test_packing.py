import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from seawake.llm import packing
from tests.llm.conftest import frame, sample_texts

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer():
    rng = random.Random(1)
    alphabet = (" \n\t\r'.,!?-_%$&*#|<>/\\\"0123456789aAbBeElLmMsStTvVéüßñçÇØøĿŉ–—‘’“”…€¼² ­ 　"
                "\x1c\x85\x0b\x0c中文😀ſİǅʰ́")
    enc = packing.encoder()
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [" it's they'll WE'RE 'tis x'd", "a<|endoftext|>b", "y" * 3000, "\n\n\n  x  \n", "end  ", *filter(None, sample_texts())]
    for t in texts:
        assert enc.ids(t).tolist() == ids_of(t), repr(t)


def test_every_code_point_of_the_fast_set_agrees():
    enc = packing.encoder()
    for c in map(chr, range(0x20, 0x250)):
        for t in (f"ab{c}cd", f" {c}{c} 1{c}", f"{c} x", f"a {c}"):
            assert enc.ids(t).tolist() == ids_of(t), hex(ord(c))


def test_long_runs_are_found_whatever_their_place():
    for n in (packing._RUN - 1, packing._RUN, packing._RUN + 1, 3 * packing._RUN):
        for before in (0, 1, 7, 499, 500, 501, 1234):
            for blank in (" ", "\n"):
                text = "ab " * (before // 3) + "c" * (before % 3) + blank + "y" * n + blank + "end of it"
                assert packing._long_run(text) == (n >= packing._RUN)
    assert not packing._long_run("")
    assert packing.rare("a<|endoftext|>") and packing.rare("中") and not packing.rare("plain text\n")


def slow_first_fit(sizes, capacity):
    free, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((k for k, f in enumerate(free) if f >= sizes[i]), None)
        if b is None:
            b = len(free)
            free.append(capacity)
        out[i] = (b, capacity - free[b])
        free[b] -= sizes[i]
    return out


def test_first_fit_equals_linear_scan():
    rng = random.Random(7)
    for n in (0, 1, 2, 3, 50, 257):
        sizes = [rng.randint(1, 64) for _ in range(n)]
        assert packing.first_fit_decreasing(sizes, 64) == slow_first_fit(sizes, 64)


def check(rows, texts_by_id, length):
    """Every id in exactly one piece, checksums right, sequences gapless and not overfull."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, texts in texts_by_id.items():
        want = []
        for t in texts:
            ids = [*ids_of(t), 1]
            want += [(s, len(ids[s:s + length]), zlib.crc32(np.array(ids[s:s + length], "<u4").tobytes()), len(ids))
                     for s in range(0, len(ids), length)]
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[i]) == sorted(want)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return by_seq


def test_packing_is_whole_gapless_and_tight(docs):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for length, group in ((2048, 4096), (64, 10)):
        rows = packing.pack(docs, length=length, group_docs=group).collect()
        seqs = check(rows, texts, length)
        used = sum(r.length for r in rows)
        assert len(seqs) <= used / length + 2 + sum(map(len, texts.values())) / group + 1


def test_sequences_hold_the_ids_and_padding(docs):
    texts = sorted(ids_of(r.text) + [1] for r in docs.collect())
    for length, group in ((2048, 4096), (64, 10)):
        table = packing.sequences(docs, length=length, group_docs=group)
        rows, parts, placed = table.collect(), {}, []
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == length
            used = sum(p.length for p in r.pieces)
            assert ids[used:] == [packing.PAD_ID] * (length - used)
            for p in r.pieces:
                part = ids[p.offset:p.offset + p.length]
                parts.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, part))
                crc = zlib.crc32(np.array(part, "<u4").tobytes())
                placed.append((str(p.doc_id), p.start, p.length, crc, p.doc_tokens, r.sequence_id, p.offset))
        assert len({r.sequence_id for r in rows}) == len(rows)
        assert sorted((str(r[0]), *r[1:]) for r in packing.placements(table).collect()) == sorted(placed)
        alone = [sorted(v) for v in parts.values() if len({s for s, _ in v}) == len(v)]
        whole = [sum((x for _, x in v), []) for v in alone]
        assert len(whole) > 30 and all(w in texts for w in whole)
        assert sum(len(x) for v in parts.values() for _, x in v) == sum(map(len, texts))


def test_empty_table_and_empty_texts(spark, no_docs):
    assert packing.pack(no_docs).count() == 0
    rows = packing.pack(frame(spark, [None, "", " "], [None, 5, 5])).collect()
    assert sorted(r.doc_tokens for r in rows) == [1, 1, 2] and len({r.sequence_id for r in rows}) == 1
