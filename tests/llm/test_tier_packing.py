"""Tiered packing: exact round trip, no padding, few cuts, balanced steps."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from tidelog.llm import tier_packing
from tidelog.llm.common import source

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a", "a ", "a..b . c,\n\nd", "日本 x\x00\x1f", "<s> </s> <|endoftext|>", "Nazlı İ, geldi", "\r\n\t|", "ß " * 3000]


def holds(got, known, capacity):
    """Every id once, sequences gapless, none padded; returns the pieces of each sequence."""
    docs, sequences = {}, {}
    for r in got:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append(r)
    want = {}
    for doc, ids in known:
        want.setdefault((doc, len(ids)), []).append(ids)
    assert docs.keys() == want.keys()
    for key, pieces in docs.items():
        same = want[key]
        # Rows with one id and one text: each piece comes as often as the rows.
        for start, length, crc in pieces:
            assert crc == zlib.crc32(np.array(same[0][start : start + length], "<u4").tobytes())
        cover = np.zeros(key[1], int)
        for start, length, _ in pieces:
            cover[start : start + length] += 1
        assert (cover == len(same)).all()
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity and at & (at - 1) == 0 and {r.context for r in pieces} == {at}
    return sequences


def test_documents_round_trip_without_padding(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in source(spark, SF, "documents").select("doc_id", "text").collect()}
    rows = [*texts.items(), *enumerate(ODD, 10_000), (20_000, None), (20_000, None), (None, "a b"), (None, "a b")]
    known = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    got = tier_packing.pack_documents(docs(*rows), 512, (64, 128, 256, 512), 4096, path=WORDS).collect()
    sequences = holds(got, known, 512)
    assert sorted(sequences) == list(range(len(sequences)))
    least = sum(-(-len(ids) // 512) for _, ids in known)
    assert least <= len(got) <= 1.35 * least
    # Every step has nearly the same number of tokens, and steps follow each other.
    tokens, first = {}, {}
    for r in got:
        tokens[r.step] = tokens.get(r.step, 0) + r.length
        first.setdefault(r.step, []).append(r.sequence_id)
    assert sorted(tokens) == list(range(len(tokens))) and max(tokens.values()) - min(tokens.values()) <= 4 * 512
    assert all(max(first[s]) < min(first[s + 1]) for s in range(len(first) - 1))
    assert tier_packing.pack_documents(docs(*rows).limit(0), path=WORDS).count() == 0


def test_the_whole_table(spark):
    got = tier_packing.op13_tier_packing(spark, SF).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    rows = source(spark, SF, "documents").select("doc_id", "text").collect()
    holds(got, [(r.doc_id, [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in rows], 2048)


@pytest.mark.parametrize(
    "lengths",
    [{1: 1}, {1: 5000}, {100: 5}, {1500: 10_000}, {1500: 10_000, 1300: 10_000, 900: 10_000}, {2048: 7, 2047: 3}, {1025: 1}, {3: 7, 700: 2}, {}],
)
def test_plan_fills_every_window(lengths):
    hist = np.zeros(2049, np.int64)
    for n, count in lengths.items():
        hist[n] = count
    check_plan(hist)


def test_plan_on_random_histograms():
    rng = np.random.default_rng(13)
    for most in (2, 40, 5000):
        hist = rng.integers(0, most, 2049) * (rng.random(2049) < rng.random())
        hist[0] = 0
        ranges, windows, pieces = check_plan(hist)
        # A cut fills its window: at most one for each.
        assert ranges[:, 3].sum() <= pieces + sum(windows.values())


def check_plan(hist):
    ranges, windows = tier_packing.plan(hist)
    total = int(hist @ np.arange(2049))
    assert sum(c * n for c, n in windows.items()) == total
    filled = {c: np.zeros(n, np.int64) for c, n in windows.items()}
    for _, _, _, count, size, window, offset, context in ranges[np.argsort(ranges[:, 6], kind="stable")].tolist():
        assert (filled[context][window : window + count] == offset).all()
        filled[context][window : window + count] += size
    assert all((f == c).all() for c, f in filled.items())
    # Every place of every piece once.
    for n in np.flatnonzero(hist).tolist():
        mine = ranges[ranges[:, 0] == n]
        assert (mine[:, 3] @ mine[:, 4]) == n * hist[n]
        assert (mine[:, 2] >= 0).all() and (mine[:, 2] + mine[:, 3] <= hist[n]).all()
        if hist[n] <= 50:
            cover = np.zeros((hist[n], n), int)
            for _, at, first, count, size, *_ in mine.tolist():
                cover[first : first + count, at : at + size] += 1
            assert (cover == 1).all()
    return ranges, windows, int(hist.sum())


def test_contexts_are_checked(spark, docs):
    with pytest.raises(ValueError, match="powers of two"):
        tier_packing.pack_documents(docs((1, "a")), 2048, (300, 2048), path=WORDS)
