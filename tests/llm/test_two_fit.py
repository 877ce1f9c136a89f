import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from waymark.llm import two_fit as m

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def check_plan(counts, limit):
    made = m.best_plan(counts, limit)
    held = Counter()
    for lengths, times in made:
        assert sum(lengths) <= limit and times > 0
        for n in lengths:
            held[n] += times
    assert held == {n: int(c) for n, c in enumerate(counts) if c}
    return sum(t for _, t in made)


def test_plans_hold_every_piece_once_in_few_sequences():
    rnd = np.random.default_rng(3)
    for limit, most in ((10, 9), (64, 40), (1024, 700)):
        for _ in range(20):
            counts = np.zeros(limit + 1, np.int64)
            for n in rnd.integers(1, limit + 1, rnd.integers(1, 60)):
                counts[n] = rnd.integers(0, most)
            n = check_plan(counts, limit)
            # no plan does with less than the tokens or the pieces over half a sequence need
            least = max(-(-int((counts * np.arange(limit + 1)).sum()) // limit), int(counts[limit // 2 + 1 :].sum()))
            assert n <= least * 1.2 + 1


def brute(lengths, limit):
    """The least number of sequences, by search."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in sorted(set(bins)):
            if k + lengths[i] <= limit:
                rest = list(bins)
                rest.remove(k)
                go(i + 1, [*rest, k + lengths[i]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


def first_fit(lengths, limit):
    """Sequences of first fit, longest first."""
    room = []
    for n in sorted(lengths, reverse=True):
        k = next((i for i, free in enumerate(room) if free >= n), len(room))
        if k == len(room):
            room.append(limit)
        room[k] -= n
    return len(room)


def test_close_to_the_best_of_all_packings():
    rnd = random.Random(5)
    worse = 0
    for _ in range(60):
        lengths = sorted((rnd.randint(2, 14) for _ in range(rnd.randint(1, 9))), reverse=True)
        n, least = check_plan(np.bincount(lengths, minlength=21), 20), brute(lengths, 20)
        assert n <= least + 1
        worse += n > least
    assert worse <= 3


def test_two_shorter_pieces_replace_the_smallest():
    # greedy: 6 + 3, one free; the 3 makes way for 2 + 2
    counts = np.bincount([6, 3, 2, 2, 7], minlength=11)
    stock = m._Stock(np.bincount([6, 3, 2, 2], minlength=11))
    assert m.filled(stock, 10) == [6, 2, 2] and m.filled(stock, 10) == [3]
    stock = m._Stock(np.bincount([6, 3, 2, 2], minlength=11))
    assert m.filled(stock, 10, swap=9) == [6, 3]
    assert check_plan(counts, 10) == 2


def test_pieces_against_the_library(spark):
    rnd = random.Random(9)
    texts = [None, "", " ", "é日本 😀", "the " * 5000, "a b " * 512, "x" * 3000, "<|endoftext|>"] + [" ".join(rnd.choices(["one", "two", "Three", "\n", "4"], k=rnd.randint(0, 700))) for _ in range(150)]
    rows = [(i // 2 * 3, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "null id", "clash", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, length int").repartition(5)
    got = m.pack(docs, BYTE, with_ids=True).collect()
    t = Tokenizer.from_file(BYTE)
    want = []
    for d, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        at = [0, *range(first, len(ids), 1024), len(ids)]
        for k, (a, b) in enumerate(zip(at, at[1:])):
            want.append((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(by) <= first_fit([r.length for r in got], 1024)
    whole = m.sequences(m.pack(docs, BYTE, with_ids=True)).collect()
    assert sum(len(r.ids) // 4 for r in whole) == sum(r.n_tokens for r in whole) == total and sum(len(r.doc_ids) for r in whole) == len(got)
    assert m.pack(docs.limit(0), BYTE).count() == 0
    assert "ids" not in m.pack(docs, BYTE).columns


@pytest.mark.parametrize("n, want", [(1, [1]), (1024, [1024]), (1025, [1, 1024]), (2048, [1024, 1024]), (3000, [952, 1024, 1024])])
def test_cuts(n, want):
    assert m.cuts(n, 1024) == want
