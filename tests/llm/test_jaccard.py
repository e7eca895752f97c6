"""Components and survivors against all pairs."""

import random

import numpy as np
import pytest

from gaugeworks.llm import jaccard
from gaugeworks.llm.common import Shared
from gaugeworks.llm.components import components
from gaugeworks.llm.jaccard import drop_near_duplicates, jaccard_groups
from tests.llm import cases


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def plain(rows, n, percent):
    sets = [shingles(t, n) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    least = {r: min((rows[i][0] for i in g if rows[i][0] is not None), default=None) for r, g in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))], groups


def edited(text, edits, seed):
    r = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


def family(spark_seed):
    """Copies around two centres, chains between, copies of copies, and unrelated texts."""
    r = random.Random(spark_seed)
    rows, i = [], 0
    for size in (12, 40, 130, 300):
        base = cases.words(r.random(), size, 3000)
        rows.append(cases.doc(i := i + 1, base))
        other = edited(base, max(1, size // 25), r.random())
        for _ in range(14):
            rows.append(cases.doc(i := i + 1, edited(base, r.randrange(0, max(2, size // 18)), r.random())))
            rows.append(cases.doc(i := i + 1, edited(other, r.randrange(0, max(2, size // 30)), r.random())))
        chain = base
        for _ in range(8):
            chain = edited(chain, max(1, size // 50), r.random())
            rows.append(cases.doc(i := i + 1, chain))
        rows.append(cases.doc(i := i + 1, base + " " + cases.words(r.random(), max(1, size // 12))))
    rows += [cases.doc(i + k, cases.words(k, 60, 3000)) for k in range(1, 20)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "percent", "seed", "part"), [(3, 90, 1, 200), (5, 80, 2, 200), (1, 60, 3, 200), (5, 80, 4, 3), (1, 60, 5, 7)])
def test_components_equal_all_pairs(spark, monkeypatch, n, percent, seed, part):
    monkeypatch.setattr(jaccard, "PART", part)  # groups above it go over the cluster
    rows = family(seed)
    got = jaccard_groups(cases.frame(spark, rows), Shared(spark, "t"), n, percent)
    want, _ = plain(rows, n, percent)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(want)


def test_odd_rows(spark):
    rows = cases.odd()
    got = jaccard_groups(cases.with_extra(cases.frame(spark, rows)), Shared(spark, "t"), 3, 90).collect()
    want, _ = plain(rows, 3, 90)
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got))) == sorted(map(str, want))
    assert jaccard_groups(cases.frame(spark, []), Shared(spark, "t")).collect() == []


def test_one_of_each_group_stays(spark):
    rows = family(5) + cases.odd(10_000)
    docs = cases.with_extra(cases.frame(spark, rows))
    kept = drop_near_duplicates(docs, 5, 80)
    assert kept.columns == docs.columns
    _, groups = plain(rows, 5, 80)
    want = []
    for group in groups.values():
        some = [rows[i] for i in group if shingles(rows[i][1], 5)]
        if not some:
            want += [rows[i][0] for i in group]
        else:
            want.append(min((r[0] for r in some if r[0] is not None), default=None))
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_links_of_a_group_equal_all_pairs(percent):
    r = np.random.default_rng(percent)
    for _ in range(60):
        centres = [r.choice(400, 60, replace=False) for _ in range(3)]
        sets = []
        for _ in range(20):
            own = set(centres[r.integers(3)].tolist())
            for x in r.choice(400, r.integers(0, 14)):
                own ^= {int(x)}
            sets.append(np.array(sorted(own), np.uint64))
        pivot, others = sets[0], sets[1:]

        def linked(a, b):
            both = len(set(a.tolist()) & set(b.tolist()))
            return 100 * both >= percent * (len(a) + len(b) - both)

        ball = {i for i, s in enumerate(others) if linked(pivot, s)}
        want = {(-1, i) for i in ball} | {
            (i, j) for i in range(len(others)) for j in range(i + 1, len(others)) if not {i, j} <= ball and linked(others[i], others[j])
        }
        assert set(jaccard.group_links(pivot, others, percent)) == want


def test_names_that_two_sets_share_are_made_anew(spark, monkeypatch):
    """With names cut to a few bits sets meet, and another salt is tried until none do."""
    rows = [cases.doc(i, cases.words(i, 12)) for i in range(6)]
    docs = cases.frame(spark, rows).withColumn("key", jaccard.row_key()).select("key", "doc_id", "text")
    whole = jaccard.digest
    monkeypatch.setattr(jaccard, "digest", lambda own, salt=0: whole(own, salt) % 32 if salt % 2 == 0 else whole(own, salt))
    members, _ = jaccard._named(docs, Shared(spark, "t"), 3)
    assert len({r["node"] for r in members.collect()}) == 6


def test_a_long_chain_settles(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    got = components(links, Shared(spark, "t")).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_small_parts_make_no_regions(percent):
    """A set has one region more than its sets may differ, in each size range, and linked sets share one."""
    r = np.random.default_rng(percent)
    for _ in range(60):
        n = int(r.integers(5, 400))
        own = np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
        k = [k for k in range(40) if jaccard._BOUNDS[k + 1] > n and jaccard._BOUNDS[k] <= n * 100 // percent]
        allowed = [int(jaccard._BOUNDS[i + 1] - 1) * (100 - percent) // percent for i in k]
        assert len(jaccard.region_keys(own, percent)) == sum(t + 1 for t in allowed if t)
        lost = r.random(n) < r.random() * (100 - percent) / 100
        other = np.unique(np.concatenate([own[~lost], r.integers(0, 1 << 64, int(lost.sum()) // 2, dtype=np.uint64)]))
        both = len(np.intersect1d(own, other))
        if 100 * both >= percent * (len(own) + len(other) - both) and both < max(n, len(other)):
            assert len(np.intersect1d(jaccard.region_keys(own, percent), jaccard.region_keys(other, percent)))


def test_copies_around_no_pivot_make_few_pairs(spark, monkeypatch):
    """Copies of one text, most of them too far from every other to link: the pairs that are
    measured do not grow with the square of the group, and no link is lost."""
    monkeypatch.setattr(jaccard, "PART", 20)
    r = random.Random(7)
    base, common = cases.words(1, 150, 3000), [f"c{i}" for i in range(30)]

    def copy():
        w = base.split()
        for at in r.sample(range(len(w)), r.randrange(2, 12)):
            w[at] = r.choice(common)
        return " ".join(w)

    rows = [cases.doc(i, copy()) for i in range(300)]
    shared = Shared(spark, "t")
    got = jaccard_groups(cases.frame(spark, rows), shared, 5, 80)
    want, groups = plain(rows, 5, 80)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(want)
    assert len(groups) > 100
    assert spark.read.parquet(f"{shared.folder}/across").count() < 10 * len(rows)


def test_differences_come_rarest_first():
    """Counted by buckets, what many members share stands behind what few have; ties by hash."""
    common, rare = np.array([5 << 55, 9 << 55], np.uint64), np.array([1 << 60, 3 << 60], np.uint64)
    counts = np.bincount(jaccard._bucket(np.concatenate([common, common, rare])), minlength=1 << jaccard.BUCKET_BITS)
    assert jaccard.rarest_first(np.concatenate([common, rare]), counts).tolist() == [*rare.tolist(), *common.tolist()]
    assert sorted(jaccard.difference(common, np.append(common[:1], rare)).tolist()) == sorted([int(common[1]), *rare.tolist()])
