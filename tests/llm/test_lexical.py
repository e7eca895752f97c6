"""Ranked search against a plain loop over documents and items."""

import math
import random
import re
from collections import Counter, defaultdict

from gaugeworks.llm import lexical
from gaugeworks.llm.common import Shared
from tests.llm import cases


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, top=20):
    bags = [(d[0], Counter(terms(d[1]))) for d in docs]
    n_docs, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    texts = defaultdict(set)
    for item, text in items:
        texts[item].add(text)
    out = []
    for item, own in texts.items():
        asked = Counter(t for text in own for t in terms(text))
        found = []
        for doc_id, bag in bags:
            if not bag:
                continue
            m = 75 + 25 * sum(bag.values()) * n_docs // length
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                for t, n in asked.items() if t in bag
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank + 1, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=str)


def rows(seed, n):
    r = random.Random(seed)
    made = [cases.doc(i, " ".join(f"w{int(r.random() ** 2 * 60)}" for _ in range(r.randrange(1, 30)))) for i in range(n)]
    copies = [cases.doc(1000 + i, made[3][1]) for i in range(60)] + [cases.doc(2000 + i, made[4][1] + " unasked words here") for i in range(30)]
    return [*made, *copies, *cases.odd(5000)]


ITEMS = [
    (1, "w1 w2 w3 w1"), (2, "W5, w6; w7!"), (3, None), (4, ""), (5, "nothing of it there"), (6, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w20 w30 w40"),
    (1, "w1 w2 w3 w1"), (2, "w50"), (None, "w11 w12"), (7, "éàü ñandú 漢字"), (8, "one two"),
]


def found(spark, docs, items, extra=False, **kw):
    docs = cases.frame(spark, docs).repartition(6)
    items = spark.createDataFrame(items, "item_id long, text string")
    if extra:
        docs, items = cases.with_extra(docs), cases.with_extra(items)
    got = lexical.ranked_search(docs, items, Shared(spark, "t"), **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_all_against_all(spark):
    docs = rows(1, 300)
    assert found(spark, docs, ITEMS, extra=True) == plain(docs, ITEMS)


def test_blocks_and_small_passes(spark, monkeypatch):
    docs = rows(2, 120)
    monkeypatch.setattr(lexical, "CELLS", 16)  # in this process; workers are forked from it
    assert found(spark, docs, ITEMS, block_words=7, top=5) == plain(docs, ITEMS, top=5)


def test_classes_keep_two_bags_of_one_length_apart(spark):
    docs = [cases.doc(i, f"w{i % 2} filler") for i in range(100)]
    items = [(1, "w0"), (2, "w1"), (3, "filler w1 w0")]
    assert found(spark, docs, items) == plain(docs, items)


def test_best_keeps_the_smallest_ids():
    best = lexical._Best(1, 3)
    import numpy as np
    import pyarrow as pa

    members = pa.array([[5], [1, 9], [7], [3]])
    first = np.array([5, 1, 7, 3])
    for k in range(4):
        best.add(np.array([0]), np.array([10]), first[k : k + 1], np.array([k]), members)
    best.fold()
    assert [best.members[k] for k in best.rows[:, 3]] == [[1, 9], [3], [5]]


def test_empty(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, rows(1, 5), []) == []
    assert found(spark, [cases.doc(1, None)], ITEMS) == []


def test_sums_are_exact():
    """Scores beyond 2 ** 53 in parts: high and low halves add up."""
    import numpy as np

    value = np.array([(1 << 50) + 3, (1 << 50) + 5, 7], np.int64)
    high, low = np.bincount([0, 0, 0], weights=value >> 26), np.bincount([0, 0, 0], weights=value & (1 << 26) - 1)
    assert (int(high[0]) << 26) + int(low[0]) == int(value.sum())
