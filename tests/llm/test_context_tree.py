"""Context-tree weighting against a plain recursive tree."""

import math
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, fold
from gaugeworks.llm.context_tree import END, hashed_chunks, op1_context_tree, tree_scores
from tests.llm import cases

DEPTH = 3


def stream(text):
    low = (text or "").encode().lower()
    return b"".join(w + b" " for w in low.split()) + bytes([END])


def steps(data, depth):
    padded = bytes(depth) + data
    for i in range(depth, len(padded)):
        yield padded[i - depth : i], padded[i]


def plain(train, texts, depth):
    counts = Counter()
    for t in train:
        for context, symbol in steps(stream(t), depth):
            for d in range(depth + 1):
                c = context[depth - d :]
                for k in range(8):
                    counts[c, (1 << k) | symbol >> (8 - k), symbol >> (7 - k) & 1] += 1
    longer = {}
    for c, _, _ in counts:
        if c:
            longer.setdefault(c[1:], set()).add(c)

    def own(c, node):
        a, b = counts[c, node, 0], counts[c, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(c, node):
        e = own(c, node)
        if len(c) == depth:
            return e
        s = sum(weighted(x, node) for x in sorted(longer.get(c, ())))
        m = max(e, s)
        return m + math.log(math.exp(e - m) + math.exp(s - m)) - math.log(2)

    def one(context, node, d):
        c = context[depth - d :]
        a, b = counts[c, node, 0], counts[c, node, 1]
        p = (b + 0.5) / (a + b + 1)
        if d == depth:
            return p
        w = math.exp(own(c, node) - math.log(2) - weighted(c, node))
        return w * p + (1 - w) * one(context, node, d + 1)

    out = []
    for t in texts:
        total = 0.0
        for context, symbol in steps(stream(t), depth):
            for k in range(8):
                p = one(context, (1 << k) | symbol >> (8 - k), 0)
                total += math.log10(p if symbol >> (7 - k) & 1 else 1 - p)
        out.append(total)
    return out


@pytest.mark.parametrize("chunk_bytes", [200, 1 << 20])
def test_scores_equal_a_plain_tree(spark, chunk_bytes):
    rows = [cases.doc(i, cases.words(i, 25, 9)) for i in range(14)] + [cases.doc(20, ""), cases.doc(21, None), cases.doc(22, "ÀB b\n c\xa0d")]
    docs = cases.frame(spark, rows).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("doc_id") % 4 != 1).alias("trained")
    )
    docs = docs.withColumn("chunk", hashed_chunks(docs, chunk_bytes))
    got = {r["doc_id"]: r for r in tree_scores(docs, Shared(spark, "t"), DEPTH).collect()}
    train = [r[1] for r in rows if r[0] % 4 != 1]
    for (i, text, *_), want in zip(rows, plain(train, [r[1] for r in rows], DEPTH), strict=True):
        assert got[i]["score"] == pytest.approx(want, rel=1e-9, abs=1e-9)
        assert got[i]["held_out"] == (i % 4 == 1)
    tokens = Counter(w for t in train for w in [*(t or "").encode().lower().split(), None])
    total = sum(tokens.values())
    for i, text, *_ in rows:
        own = [*(text or "").encode().lower().split(), None]
        assert got[i]["train_tokens"] == total and got[i]["n_tokens"] == len(own)
        assert got[i]["n_known"] == sum(tokens[w] > 0 for w in own)
        assert got[i]["base_score"] == pytest.approx(
            sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (len(tokens) + 1))) for w in own)
        )


def test_odd_rows_and_an_empty_table(spark):
    rows = cases.odd()
    docs = cases.frame(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit(True).alias("trained"))
    docs = docs.withColumn("chunk", hashed_chunks(docs))
    got = tree_scores(docs, Shared(spark, "t"), 5).collect()
    assert len(got) == len(rows) and all(r["score"] < 0 for r in got)
    none = docs.limit(0)
    assert tree_scores(none.withColumn("chunk", F.lit(0).cast("long")), Shared(spark, "t"), 5).collect() == []
    untrained = docs.withColumn("trained", F.lit(False)).where("doc_id = 5")
    (row,) = tree_scores(untrained, Shared(spark, "t"), 5).collect()
    assert row["score"] == pytest.approx(9 * 8 * math.log10(0.5)) and row["n_known"] == 0


def test_the_query_with_clashing_columns(spark, tmp_path):
    """Its own chunks, by file and row, also of rows that are quite the same."""
    rows = [cases.doc(i, cases.words(i, 30, 9)) for i in range(30)] + [cases.doc(40, cases.words(1, 20, 9))] * 9 + cases.odd(100)
    docs = cases.with_extra(cases.frame(spark, rows))
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_context_tree(spark, str(tmp_path)).collect()
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (fold(10) != 0).alias("trained"), F.lit(0).cast("long").alias("chunk"))
    want = tree_scores(plain, Shared(spark, "t")).collect()
    one = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["score"], 6))
    assert sorted(map(one, got)) == sorted(map(one, want))


def test_upper_tables_are_those_of_one_shard():
    """Depths 2 to 0 from shards equal the tree of all grams in one."""
    import numpy as np
    import pyarrow as pa

    from gaugeworks.llm import context_tree as t

    r = np.random.default_rng(4)
    codes = np.unique(r.integers(0, 6, (4000, 6)) @ (256 ** np.arange(5, -1, -1)))
    counts = r.integers(0, 9, len(codes))
    ends = codes >> 8 & 0xFFFFFF
    parts = [t._rooted(5)(pa.table({"key": codes[ends % 7 == k], "n": counts[ends % 7 == k]})) for k in range(7)]
    both = pa.concat_tables(parts).group_by("place").aggregate([("n0", "sum"), ("n1", "sum"), ("weighted", "sum")])
    both = both.rename_columns(["place", "n0", "n1", "weighted"])
    many, one = t.upper_tables(both), t.upper_tables(t._rooted(5)(pa.table({"key": codes, "n": counts})))
    assert all(np.allclose(a, b) for a, b in zip(many, one, strict=True))
