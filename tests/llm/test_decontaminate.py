import hashlib
import random
import re

import pytest

from gaugeworks.llm.common import Shared
from gaugeworks.llm.decontaminate import decontaminate, matches
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def plain(text, items, window):
    w = words(text)
    hit, found, longest = set(), set(), 0
    for name, item in items:
        v = words(item)
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else []:
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add("" if name is None else str(name))
    return len(w), sorted(hit), sorted(found)


def data(seed=1):
    r = random.Random(seed)
    pool = [f"k{i}" for i in range(12)]
    items = [(i, " ".join(r.choice(pool) for _ in range(r.randrange(1, 30)))) for i in range(25)]
    items += [(3, "Duplicate id, of K1 k2 k3 k4 k5"), (None, "no id k9 k9 k9 k9 k9 k9 k9"), (90, None), (91, " .. "), (92, items[7][1])]
    docs = []
    for i in range(60):
        parts = [" ".join(r.choice(pool + ["zz", "q"]) for _ in range(r.randrange(0, 60)))]
        if i % 3 == 0:
            v = words(r.choice(items[:25])[1])
            a = r.randrange(len(v))
            parts.insert(r.randrange(2), "«" + ", ".join(v[a:]).upper() + "!»")
        docs.append(cases.doc(i, " — ".join(parts)))
    return docs + cases.odd(500), items


def spans(flat):
    return [k for a, b in zip(flat[::2], flat[1::2], strict=True) for k in range(a, b)]


@pytest.mark.parametrize(("window", "block"), [(13, 200_000), (4, 40), (6, 1)])
def test_matches_equal_plain_search(spark, window, block):
    docs, items = data()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = cases.frame(spark, docs)
    got = matches(frame.selectExpr("doc_id", "text AS gw_text"), bench, Shared(spark, "t"), window, block).collect()
    want = sorted(str((d[0], *plain(d[1], items, window))) for d in docs)
    assert sorted(str((r["doc_id"], r["gw_words"], spans(r["gw_spans"]), r["gw_items"])) for r in got) == want
    assert all(r["gw_hit"] == len(spans(r["gw_spans"])) for r in got)


def test_rows_over_the_limit_go_and_spans_are_cut(spark):
    passage = cases.words(1, 20)
    docs = [
        cases.doc(1, f"Before, {passage} — after."),
        cases.doc(2, f"{cases.words(2, 600)} Start {passage.upper()}; end."),
        cases.doc(3, cases.words(3, 50)), cases.doc(4, None), (None, "", None, None, None),
    ]
    frame = cases.with_extra(cases.frame(spark, docs))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = decontaminate(frame, bench)
    assert got.columns == frame.columns
    out = {r["doc_id"]: r for r in got.collect()}
    assert set(out) == {2, 3, 4, None}
    assert out[2]["text"] == f"{cases.words(2, 600)} Start ; end." and out[2]["n_chars"] == len(out[2]["text"])
    assert out[3]["text"] == docs[2][1] and out[4]["text"] is None
    nothing = bench.limit(0)
    assert decontaminate(frame, nothing).count() == 5 and decontaminate(frame.limit(0), bench).count() == 0


def test_digest_of_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
