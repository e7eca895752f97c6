"""Learned scores: held-out accuracy, exact neighbours, replayed rates, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import language_centroids, mixing, quality_net, toxicity
from gaugeworks.llm.common import Shared
from tests.llm import cases

INSULTS = ["grok", "blarg", "snorf"]


def language(i):
    return "xx" if i % 2 else "yy"


def text(i, n=60):
    r = np.random.default_rng(i)
    a, b = ("bdg", "aou") if i % 2 else ("kpt", "eiy")
    word = lambda: "".join(r.choice(list(a)) + r.choice(list(b)) for _ in range(r.integers(1, 4)))
    return " ".join(word() for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = [], []
    for i in range(240):
        t, bad, toxic = text(i), i % 5 == 0, i % 7 == 0
        if bad:
            t = t.replace(" ", "!! ").upper()
        if toxic:
            t += f" {INSULTS[i % 3]} end {INSULTS[(i + 1) % 3]}"
        docs.append(cases.doc(i, t, language(i)))
        labels.append((i, int(not bad), int(toxic)))
    return cases.frame(spark, docs + cases.odd(1000)), spark.createDataFrame(labels + [(None, 1, 1), (1001, None, None), (1002, 1, 0)], "doc_id long, quality int, toxic int")


def rows_of(docs, fold):
    return docs.select("doc_id", (F.coalesce(F.col("doc_id"), F.lit(0)) % fold == 1).alias("held_out"), "text")


def test_quality_net(spark, tables):
    docs, labels = tables
    net = quality_net.fit(docs, labels, "quality", 3, 1, per_class=100)
    got = rows_of(docs, 3).mapInArrow(quality_net._score(spark.sparkContext.broadcast(net)), "doc_id long, held_out boolean, score double").collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 5 != 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 240]
    assert np.mean(right) > 0.95
    empty = {r["score"] for r in got if r["doc_id"] in (1001, 1002)}
    assert len(empty) == 1
    # Looking up byte pairs is the same network, and every window of a long text counts.
    raw = np.frombuffer(("x" * 5000 + "BAD!! BAD!!" + "y" * 777).encode(), np.uint8)
    plain, paired = quality_net.Network(3), quality_net.Network(3).freeze()
    at = np.array([0, len(raw)])
    assert plain.logits(raw, at) == pytest.approx(paired.logits(raw, at), abs=1e-4)
    full = np.array([sum(plain.taps[k][raw[i + k]] for k in range(quality_net.WIDTH)) for i in range(len(raw) - 7)])
    assert (plain.pooled(quality_net.chunked(raw, at)[0]).max(axis=0) >= np.maximum(full.max(axis=0), 0) - 1e-4).all()
    assert quality_net.fit(docs, labels.limit(0), "quality", 3, 1) is None
    none = rows_of(docs, 3).mapInArrow(quality_net._score(spark.sparkContext.broadcast(None)), "doc_id long, held_out boolean, score double")
    assert {r["score"] for r in none.collect()} == {0.5}


def test_language_centroids(spark, tables):
    docs, _ = tables
    model = language_centroids.fit(docs.where("doc_id % 4 <> 2").select("doc_id", "text", "lang").where("doc_id < 240"))
    got = language_centroids.predict(rows_of(cases.with_extra(docs), 4), model).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 240]
    assert np.mean([r["lang_pred"] == language(r["doc_id"]) for r in held]) > 0.98
    by = {r["doc_id"]: r for r in got}
    assert all(by[1000 + k]["lang_pred"] == "und" and by[1000 + k]["score"] == 0 for k in (1, 2, 3, 10))
    assert by[1009]["lang_pred"] in ("xx", "yy")
    nothing = language_centroids.predict(rows_of(docs, 4), language_centroids.fit(docs.limit(0))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def dense(index):
    """The examples' vectors out of the postings."""
    out = np.zeros((len(index.ids), len(index.terms)))
    out[index.example, np.repeat(np.arange(len(index.terms)), np.diff(index.start))] = index.posting
    return out


def test_neighbours_are_exact_and_held_out_texts_found(spark, tables):
    docs, labels = tables
    index = toxicity.fit(docs, labels, "toxic", 4, 2, per_class=120)
    vectors = dense(index)
    for v in vectors[::7]:
        terms = np.flatnonzero(v)
        cosine = vectors @ v
        want = sorted((-float(c), i) for i, c in enumerate(cosine) if c > 0)[: toxicity.NEIGHBOURS]
        got = index.nearest(terms, v[terms], toxicity.NEIGHBOURS)
        assert [c for c, _ in got] == pytest.approx([c for c, _ in want], abs=1e-5)
    schema = "doc_id long, held_out boolean, score double, cosine double, evidence string"
    got = rows_of(cases.with_extra(docs), 4).mapInArrow(toxicity._score(spark.sparkContext.broadcast(index), 0.1), schema).collect()
    own = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 240]
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 7 == 0) for r in own)
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == docs.count()
    assert toxicity.fit(docs, labels.where("toxic = 0"), "toxic", 4, 2) is None


def test_no_term_tells_classes_apart(spark):
    """Every text with a word of an example has neighbours and evidence all the same."""
    docs = cases.frame(spark, [cases.doc(i, text(i)) for i in range(12)] + [cases.doc(50, "unheard"), cases.doc(51, None)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, labels, "toxic", 4, 2)
    schema = "doc_id long, held_out boolean, score double, cosine double, evidence string"
    got = {r["doc_id"]: r for r in rows_of(docs, 4).mapInArrow(toxicity._score(spark.sparkContext.broadcast(index), 0.1), schema).collect()}
    assert len(got) == 14 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["evidence"] for i in range(12))
    assert got[50]["score"] == got[51]["score"] == index.floor and not got[50]["evidence"]


def test_insults_outweigh_chance_words():
    texts = [f"a b w{i % 50}" + (" grok" if i < 40 and i % 2 else "") for i in range(4000)]
    terms, weight = toxicity.term_weights(texts, np.array([i % 2 for i in range(4000)], float))
    of = dict(zip(terms.tolist(), weight.tolist(), strict=True))
    w = {x: of[int(toxicity._terms_of(pa.array([x]))[0][0])] for x in ("grok", "a", "w3")}
    assert len(of) == 53 and w["grok"] > 0.5  # in 20 of 2,000 toxic texts
    assert w["a"] == toxicity.LEAST  # in all texts
    # Chi-squared of one word by hand: w3 stands in 80 texts of label 1 only.
    chi2 = ((80 - 40) ** 2 / 40 + (0 - 40) ** 2 / 40) / (1 - 80 / 4000)
    assert w["w3"] == pytest.approx(chi2**2 / (chi2**2 + toxicity.CHI2**2))


def test_block_bounds_skip_but_lose_nothing():
    r = np.random.default_rng(4)
    texts = [" ".join(f"t{r.integers(40)}" for _ in range(12)) for _ in range(1500)]
    y = np.array([i % 2 for i in range(1500)], float)
    terms = np.unique(toxicity._terms_of(pa.array([f"t{i}" for i in range(40)]))[0])
    index = toxicity.Index(terms, 1 + 9 * r.random(len(terms)) ** 4, texts, y, list(range(1500)), 0.3)
    vectors = dense(index)
    assert index.n_blocks == 24
    # The bound of every block and term is the largest weight there.
    for t in range(len(terms)):
        entries = slice(index.block_start[t], index.block_start[t + 1])
        most = {int(b): float(m) for b, m in zip(index.block[entries], index.most[entries], strict=True)}
        column = vectors[:, t]
        assert most == {b: pytest.approx(m) for b in range(24) if (m := float(column[b * 64 : b * 64 + 64].max(initial=0))) > 0}
    for v in vectors[::13]:
        want = sorted(-(vectors @ v))[:9]
        at = np.flatnonzero(v)
        assert [c for c, _ in index.nearest(at, v[at], 9)] == pytest.approx(want, abs=1e-5)


def test_rates_equal_plain_descent(spark, tables):
    docs, labels = tables
    targets = {"a": 0.4, "b": 0.1, "c": 0.4, "d": 0.1}
    got = mixing.mix(cases.with_extra(docs), labels, Shared(spark, "t"), targets).toPandas()
    assert len(got) == docs.count() and (got.rate >= 0).all()
    p, w = np.array(got.posterior.tolist()), (got.n_tokens / got.n_tokens.sum()).to_numpy()
    goal, r = np.array(list(targets.values())), np.ones(len(got))
    for _ in range(20_000):
        r = np.maximum(0, r - 0.05 * (p @ (((w * r) @ p - goal) / goal) + mixing.RIDGE * (r - 1)))
    assert (w * got.rate.to_numpy()) @ p == pytest.approx((w * r) @ p, abs=2e-3)
    assert np.abs(got.rate - r).max() < 0.05
    rows = mixing.mix_rows(cases.with_extra(docs), labels, Shared(spark, "t"), targets)
    assert rows.columns[-1] == "mix_rate" and sorted(rows.toPandas().mix_rate) == pytest.approx(sorted(got.rate))
    none = mixing.mix_rows(docs.limit(0), labels.limit(0), Shared(spark, "t"))
    assert none.collect() == []
    flat = mixing.mix(docs, labels.limit(0), Shared(spark, "t"))
    assert all(x == [0.25] * 4 for x in flat.toPandas().posterior.map(list))


def test_network_equals_plain_loops():
    """The whole forward pass, and the gradient against small differences."""
    net = quality_net.Network(5)
    net.bias[:] = np.linspace(-0.3, 0.3, quality_net.FILTERS)
    texts = [b"", b"abc", bytes(range(60, 120)) * 9, b"x" * quality_net.CHUNK + b"!! end of it"]
    raw, offsets = quality_net.joined(texts)

    def plain(text):
        chunks = []
        for a in range(0, max(len(text), 1), quality_net.CHUNK):
            own = text[a : a + quality_net.CHUNK + quality_net.WIDTH - 1].ljust(quality_net.CHUNK + quality_net.WIDTH - 1, b"\0")
            sums = [
                [sum(float(net.taps[k, own[i + k], f]) for k in range(quality_net.WIDTH)) for f in range(quality_net.FILTERS)]
                for i in range(quality_net.CHUNK)
            ]
            chunks.append([max(0.0, max(s[f] for s in sums) + float(net.bias[f])) for f in range(quality_net.FILTERS)])
        most = [max(c[f] for c in chunks) for f in range(quality_net.FILTERS)]
        mean = [sum(c[f] for c in chunks) / len(chunks) for f in range(quality_net.FILTERS)]
        return sum(a * float(b) for a, b in zip(most + mean, net.out, strict=True)) + float(net.level[0])

    assert net.logits(raw, offsets) == pytest.approx([plain(t) for t in texts], abs=1e-4)
    y, weight = np.array([0.0, 1.0, 1.0, 0.0]), np.array([0.5, 1.5, 1.0, 1.0])

    def loss():
        z = net.logits(raw, offsets).astype(float)
        return float((weight * (np.logaddexp(0, z) - y * z)).mean())

    grads = quality_net.gradients(net, raw, offsets, y, weight)
    r = np.random.default_rng(2)
    for name in quality_net.NAMES:
        values, grad = getattr(net, name).reshape(-1), grads[name].reshape(-1)
        some = np.flatnonzero(grad)
        for i in r.choice(some, min(12, len(some)), replace=False):
            kept = values[i]
            values[i] = kept + 1e-2
            up = loss()
            values[i] = kept - 1e-2
            down = loss()
            values[i] = kept
            assert (up - down) / 2e-2 == pytest.approx(grad[i], abs=2e-3), name


def test_quality_query_on_an_empty_table_and_clashing_columns(spark, tables, tmp_path):
    docs, labels = tables
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    cases.with_extra(docs).write.parquet(f"{tmp_path}/documents.parquet")
    for query in (quality_net.op5_quality_net, toxicity.op3_toxicity):
        got = query(spark, str(tmp_path))
        assert {"doc_id", "held_out", "score", "predicted"} <= set(got.columns) and got.count() == docs.count()
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    for query in (quality_net.op5_quality_net, toxicity.op3_toxicity):
        assert query(spark, str(tmp_path)).collect() == []


def plain_vector(text, idf):
    low = (text or "").encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in low)
    tf = {}
    for i in range(len(low) - 2):
        gram = low[i] << 16 | low[i + 1] << 8 | low[i + 2]
        bucket = (gram * 2654435761) % (1 << 32) >> 20
        tf[bucket] = tf.get(bucket, 0) + 1
    v = {b: np.log1p(n) * float(idf[b]) for b, n in tf.items()}
    length = np.sqrt(sum(x * x for x in v.values()))
    return {b: x / length for b, x in v.items()} if length else {}


def dot(v, c):
    return sum(x * float(c[b]) for b, x in v.items())


def test_centroids_equal_plain_cosines_and_steps(spark, tables):
    docs, _ = tables
    learned = docs.select("doc_id", "text", "lang").where("doc_id < 240")
    model = language_centroids.fit(learned)
    texts = [r["text"] for r in learned.collect()]
    # Document frequencies over all texts.
    seen = np.zeros(language_centroids.BUCKETS)
    for t in texts:
        for b in plain_vector(t, np.ones(language_centroids.BUCKETS)):
            seen[b] += 1
    assert model.idf == pytest.approx(np.log((1 + len(texts)) / (1 + seen)) + 1, rel=1e-5)
    got = {r["doc_id"]: r for r in language_centroids.predict(rows_of(docs, 4), model).collect()}
    for r in docs.where("doc_id IS NOT NULL AND (doc_id % 9 = 0 OR doc_id > 1000)").dropDuplicates(["doc_id"]).collect():
        if r["doc_id"] in (1006, 1007):
            continue  # ids with two texts
        cosines = [dot(plain_vector(r["text"], model.idf), c) for c in model.centroids]
        mine = got[r["doc_id"]]
        if mine["lang_pred"] == "und":
            assert not any(c.isalpha() for c in r["text"] or "")
            continue
        names = sorted(set(model.langs))
        by = [max(c for c, x in zip(cosines, model.langs) if x == name) for name in names]
        assert mine["cosine"] == pytest.approx(max(cosines), abs=1e-4)
        assert mine["lang_pred"] == names[int(np.argmax(by))]
        weights = np.exp(language_centroids.SHARPNESS * (np.array(by) - max(by)))
        assert mine["score"] == pytest.approx(weights.max() / weights.sum(), abs=1e-3)
        near = int(np.argmax(cosines))
        if abs(cosines[near] - model.radius[near]) > 1e-4:
            assert mine["rejected"] == (cosines[near] < model.radius[near])


def test_clusters_equal_plain_steps():
    texts = [text(i) for i in range(0, 60, 2)]
    idf = np.ones(language_centroids.BUCKETS, np.float32)
    group = pa.table({"doc_id": list(range(30)), "text": texts, "lang": ["yy"] * 30})
    made = language_centroids._cluster(idf, 3)(group)
    vectors = [plain_vector(t, idf) for t in texts]
    start = np.random.default_rng(11).permutation(30)[:3]
    centre = [np.array([vectors[i].get(b, 0.0) for b in range(language_centroids.BUCKETS)]) for i in start]
    for _ in range(12):
        near = [int(np.argmax([dot(v, c) for c in centre])) for v in vectors]
        sums = [np.zeros(language_centroids.BUCKETS) for _ in centre]
        for v, c in zip(vectors, near, strict=True):
            for b, x in v.items():
                sums[c][b] += x
        centre = [s / np.linalg.norm(s) if s.any() else c for s, c in zip(sums, centre, strict=True)]
    got = [np.frombuffer(c, np.float32) for c in made.column("centroid").to_pylist()]
    assert all(np.abs(a - b).max() < 1e-4 for a, b in zip(got, centre, strict=True))
    own = [[dot(v, c) for c in centre] for v in vectors]
    for k, radius in enumerate(made.column("radius").to_pylist()):
        mine = [max(o) for o in own if int(np.argmax(o)) == k]
        assert radius == pytest.approx(np.quantile(mine, language_centroids.OUTSIDE) if mine else 0.0, abs=1e-4)


def test_equal_centroids_go_to_the_first_language(spark):
    c = np.zeros((2, language_centroids.BUCKETS), np.float32)
    c[:, :] = 1 / np.sqrt(language_centroids.BUCKETS)
    model = language_centroids.Model(["aa", "bb"], c, np.zeros(2), np.ones(language_centroids.BUCKETS, np.float32), "bb", 0.5)
    docs = cases.frame(spark, [cases.doc(1, "some text"), cases.doc(2, "x")])
    got = {r["doc_id"]: r["lang_pred"] for r in language_centroids.predict(rows_of(docs, 4), model).collect()}
    assert got == {1: "aa", 2: "bb"}  # a tie, and no vector


def test_equal_cosines_go_to_the_first_example():
    texts = ["t1 t2", "t1 t2", "t1 t3", "t1 t2"]
    terms = np.unique(toxicity._terms_of(pa.array(["t1 t2 t3"]))[0])
    index = toxicity.Index(terms, np.ones(3), texts, np.array([0.0, 1, 0, 1]), [7, 8, 9, 10], 0.3)
    at, _ = toxicity._look_up(terms, *toxicity._terms_of(pa.array(["t1 t2"])))
    near = index.nearest(*index.vector(at), 2)
    assert [index.ids[i] for _, i in near] == [7, 8] and near[0][0] == near[1][0]
