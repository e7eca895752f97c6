"""Packing against plain tokenisation, the rules of a packing, and exhaustive search."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeworks.llm import packing
from gaugeworks.llm.common import Shared
from tests.llm import cases

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TOKENIZER = Tokenizer.from_file(PATH)


def plain_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def held_against_rules(rows, docs, capacity):
    """Every document's pieces, whole and once; every sequence without gaps."""
    want = defaultdict(int)
    for r in docs:
        ids = plain_ids(r[1])
        for k, a in enumerate(range(0, len(ids), capacity)):
            own = ids[a : a + capacity]
            want[r[0], k, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    for r in rows:
        want[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] -= 1
    assert not any(want.values())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1]
        assert sum(n for _, n in own) <= capacity
    return len(sequences)


TRICKY = [
    "It's we'll DON'T 'tis O'Brien's", "a, b. c; d! (e) ... ##x y##", "ÉCOLE École ñandú Ünïcode straße İstanbul ΣΑΣ",
    "tab\tand\nlines\r\n\x0b\x0c\x1c\x1d\x85   wide", "漢字かな交じり文 without blanks", "<|endoftext|> and <|startoftext|>",
    "🙂🙃 emoji‍joined", "123 45,678.90 x1y2", "word " * 50, "́ starts with a mark", "",
]


def test_ids_are_the_tokenizers():
    r = random.Random(3)
    encoder = packing.Encoder(PATH)
    texts = [*TRICKY, *[" ".join(r.choices(" ".join(TRICKY).split(" "), k=40)) for _ in range(50)]]
    for part in (texts, texts[::-1]):
        ids, n = encoder([t.encode() for t in part])
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [plain_ids(t) for t in part]


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    encoder = packing.Encoder(PATH)
    for text in ("a b c d", "e f g h", "a b c d e f g h i j", "a"):
        assert encoder([text.encode()])[0].tolist() == plain_ids(text)


def fills(size, held):
    return np.bincount(held, weights=size)


@pytest.mark.parametrize("low,high", [(1, 100), (20, 60), (34, 50), (51, 99), (25, 26)])
def test_search_keeps_the_rules(low, high):
    for seed in range(20):
        size = np.random.default_rng(seed).integers(low, high, 200)
        first, held = packing.best_fit(size, 100), packing.pack(size, 100)
        assert fills(size, held).max() <= 100
        n, before = len(set(held.tolist())), len(set(first.tolist()))
        assert packing.least_sequences(size, 100) <= n <= before
        assert (fills(size, held) ** 2).sum() >= (fills(size, first) ** 2).sum()


def test_search_empties_sequences():
    saved = sum(
        len(set(packing.best_fit(s, 100).tolist())) - len(set(packing.pack(s, 100).tolist()))
        for s in (np.random.default_rng(k).integers(20, 45, 300) for k in range(10))
    )
    assert saved > 20


def fewest(size, capacity):
    """By trying everything."""
    best = len(size)

    def put(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(size):
            best = len(room)
            return
        for k in range(len(room)):
            if room[k] >= size[i]:
                put(i + 1, [*room[:k], room[k] - size[i], *room[k + 1 :]])
        put(i + 1, [*room, capacity - size[i]])

    put(0, [])
    return best


def test_near_the_fewest():
    r = random.Random(5)
    for _ in range(60):
        size = [r.randrange(1, 20) for _ in range(9)]
        n, least = len(set(packing.pack(np.array(size), 20).tolist())), fewest(size, 20)
        assert packing.least_sequences(np.array(size), 20) <= least <= n <= least + 1


def test_each_exchange_is_found():
    def after(size, held):
        search = packing.LocalSearch(np.array(size), np.array(held), 10)
        return len(set(search.run().tolist())), search

    assert after([6, 4], [0, 1])[0] == 1  # a move
    assert after([5, 3, 5, 4, 3], [0, 0, 1, 2, 2])[0] == 2
    size, held = [7, 3, 6, 4], [0, 2, 1, 2]
    assert after(size, held)[0] == 2
    # Two for one and one for two: neither a move nor a single exchange helps.
    search = packing.LocalSearch(np.array([4, 5, 3, 3]), np.array([0, 0, 1, 1]), 10)
    search.items = np.arange(4)
    search.i, search.j = packing.pairs(search.items, search.held, search.size)
    assert search.step(1) and search.fill.tolist() == [10, 5]


def test_table(spark):
    rows = [*cases.odd(), *[cases.doc(100 + i, cases.words(i, 5 + 7 * i)) for i in range(150)]]
    docs = cases.with_extra(cases.frame(spark, rows))
    for group in (packing.GROUP, 16):
        got = packing.packed(docs, Shared(spark, "t"), PATH, capacity=512, group=group)
        assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        out = got.collect()
        n = held_against_rules(out, rows, 512)
        assert n <= 1.02 * sum(r["length"] for r in out) / 512 + 1


def test_ties_and_empty(spark):
    rows = [cases.doc(1, "one two three four")] * 100
    out = packing.packed(cases.frame(spark, rows), Shared(spark, "t"), PATH, capacity=16, group=8).collect()
    assert held_against_rules(out, rows, 16) == 34  # three of five tokens each
    assert packing.packed(cases.frame(spark, []), Shared(spark, "t"), PATH).collect() == []
