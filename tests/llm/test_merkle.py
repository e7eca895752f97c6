"""Merkle manifest against plain recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import merkle
from gaugeworks.llm.common import Shared
from tests.llm import cases


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """Root of a list of digests, and the siblings of each leaf from the bottom up as (before, digest)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            if i ^ 1 < len(nodes):
                ways[leaf].append((bool(i & 1), nodes[i ^ 1]))
            else:
                ways[leaf].append(None)
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0] if nodes else None, ways


def plain(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    roots, own = [], []
    for lang in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, digest(*r)), r) for r in langs[lang])
        root, ways = climb([k[2] for k, _ in leaves])
        roots.append(root)
        own.append([(k[2], r, w) for (k, r), w in zip(leaves, ways, strict=True)])
    root, above = climb(roots)
    out = []
    for sub, leaves, up in zip(roots, own, above, strict=True):
        for leaf, r, way in leaves:
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                node = digest(*r[:4], r[4] + 1)
            for step in [*way, *up]:
                node = sha(node if step is None else step[1] + node if step[0] else node + step[1])
            proof = sha("".join(s[1] for s in [*way, *up] if s))
            out.append((r[0], leaf, sub, root, proof, node, node == root))
    return sorted(out, key=str)


def query(spark, folder, rows, extra=False):
    docs = cases.frame(spark, rows)
    (cases.with_extra(docs) if extra else docs).repartition(5).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    got = merkle.op12_merkle_manifest(spark, str(folder))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def langs(n, seed):
    r = random.Random(seed)
    return [cases.doc(r.randrange(10 * n), cases.words(i, 3), r.choice([None, "en", "de", "é", "", "zz"])) for i in range(n)]


@pytest.mark.parametrize("band", [1, 2, 10])
def test_bands(spark, tmp_path, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    rows = [*langs(70, band), *cases.odd(1000), *[cases.doc(5000, "same")] * 5, cases.doc(7, "alone", "one")]
    assert query(spark, tmp_path, rows, extra=band == 2) == plain(rows)


def test_more_than_a_block(spark, tmp_path):
    rows = langs(2600, 1)
    rows = [(*r[:2], "en" if r[2] in (None, "de") else r[2], *r[3:]) for r in rows] + [cases.doc(-i, "x", "en") for i in range(1, 1500)]
    assert query(spark, tmp_path, rows) == plain(rows)


def test_few(spark, tmp_path):
    for rows in ([], [cases.doc(1, "x")], [cases.doc(1, None, None)], [cases.doc(i, "x") for i in range(3)], [cases.doc(1, "a"), cases.doc(2, "b", "fr")]):
        assert query(spark, tmp_path, rows) == plain(rows)


def test_intervals(spark):
    """Nodes of a level part the leaves, and a parent covers its children."""
    docs = cases.frame(spark, [cases.doc(i, f"t{i}") for i in range(1100)])
    _, trees, _ = merkle.manifest(docs, Shared(spark, "t"))
    nodes = [r for band in trees.bands for r in band.where((F.col("level") == 0) | ~F.col("top") | (F.col("hi") - F.col("lo") == F.col("n"))).collect()]
    for level in range(12):
        own = sorted((r["lo"], r["hi"]) for r in nodes if r["level"] == level)
        assert own[0][0] == 0 and own[-1][1] == 1100 and all(a[1] == b[0] for a, b in zip(own, own[1:]))
        assert len(own) == -(-1100 // (1 << level))
