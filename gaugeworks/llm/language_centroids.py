"""Language identification by nearest centroid.

A text is a vector of hashed byte trigrams (A-Z in lower case): damped counts, weighted by inverse
document frequency over all texts that may be learned from, of unit length. Each language has
``CENTROIDS`` centroids, found by spherical k-means over about ``PER_LANGUAGE`` of its texts (the
documented bound of the fit), all languages at once as Spark groups. A text gets the language of
the nearest centroid by cosine. One further from it than nearly all of that centroid's own texts
were is marked rejected.

Texts that are null or have no letter are `und` with score 0. Texts with letters but less than
three bytes have no vector and get the commonest language with its share. Ties go to the
centroid that comes first by language. Without learned languages all is `und`.
Repeated rows and ids get a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import fold, pieces, query, table
from gaugeworks.llm.tokens import LOWER, buffers

BUCKETS = 4096
CENTROIDS = 3
PER_LANGUAGE = 600
ROWS = 256
#: Part of a centroid's own texts that its radius leaves out.
OUTSIDE = 0.01
SHARPNESS = 25.0

_U = np.uint64


def counts(column: pa.Array) -> np.ndarray:
    """(texts, buckets) trigram counts."""
    raw, offsets = buffers(column)
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), np.float32)
    if len(raw) < 3:
        return out
    low = LOWER[raw].astype(np.uint32)
    grams = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    bucket = (grams * np.uint32(2654435761)) >> np.uint32(20)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    inside = owner[:-2] == owner[2:]
    flat = np.bincount(owner[:-2][inside] * BUCKETS + bucket[inside], minlength=n * BUCKETS)
    return flat.reshape(n, BUCKETS).astype(np.float32)


def vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts(column)) * idf
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(length > 0, length, 1)


def _frequencies(batches):
    total, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in pieces(batches, rows=ROWS):
        total += (counts(batch.column("text")) > 0).sum(axis=0)
        texts += batch.num_rows
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, BUCKETS)), pa.array(np.append(texts, total))], ["bucket", "n"]
    )


def _cluster(idf: np.ndarray, k: int):
    def each(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        lang = group.column("lang")[0].as_py()
        v = np.concatenate([vectors(b.column("text"), idf) for b in pieces(iter(group.to_batches()), rows=ROWS)])
        rng = np.random.default_rng(11)
        centre = v[rng.permutation(len(v))[:k]]
        for _ in range(12):
            near = (v @ centre.T).argmax(axis=1)
            centre = np.stack([v[near == c].sum(axis=0) if (near == c).any() else centre[c] for c in range(len(centre))])
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
        near = v @ centre.T
        own = near.max(axis=1)
        radius = [float(np.quantile(own[near.argmax(axis=1) == c], OUTSIDE)) if (near.argmax(axis=1) == c).any() else 0.0 for c in range(len(centre))]
        return pa.table(
            {
                "lang": pa.array([lang] * len(centre)),
                "centroid": pa.array([c.astype(np.float32).tobytes() for c in centre], pa.binary()),
                "radius": pa.array(radius, pa.float64()),
            }
        )

    return each


class Model:
    def __init__(self, langs, centroids, radius, idf, commonest, share):
        self.langs, self.centroids, self.radius, self.idf = langs, centroids, radius, idf
        self.commonest, self.share = commonest, share


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, k: int = CENTROIDS) -> Model | None:
    """From (doc_id, text, lang), all of which may be learned from."""
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not sizes:
        return None
    seen = docs.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = {r["bucket"]: r["n"] for r in seen.collect()}
    idf = np.array([np.log((1 + df[-1]) / (1 + df[b])) + 1 for b in range(BUCKETS)], np.float32)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("centroids")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    found = docs.where(place < share).select("doc_id", "text", "lang").groupBy("lang").applyInArrow(
        _cluster(idf, k), "lang string, centroid binary, radius double"
    )
    rows = sorted(found.collect(), key=lambda r: r["lang"])
    commonest = max(sorted(sizes), key=sizes.get)
    if not rows:
        return None
    return Model(
        [r["lang"] for r in rows],
        np.stack([np.frombuffer(r["centroid"], np.float32) for r in rows]),
        np.array([r["radius"] for r in rows]),
        idf,
        commonest,
        sizes[commonest] / sum(sizes.values()),
    )


ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True


def has_letter(column: pa.Array) -> np.ndarray:
    raw, offsets = buffers(column)
    sums = np.append(0, np.cumsum(ASCII_LETTER[raw]))
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for d in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[d] = any(c.isalpha() for c in column[int(d)].as_py())
    return found


def _predict(shared_model):
    def each(batches):
        model = shared_model.value
        for batch in pieces(batches, rows=ROWS):
            column, n = batch.column("text"), batch.num_rows
            lettered = has_letter(column)
            langs, score, near, rejected = ["und"] * n, np.zeros(n), np.zeros(n), np.zeros(n, bool)
            if model is not None:
                v = vectors(column, model.idf)
                cosine = v @ model.centroids.T
                names = sorted(set(model.langs))
                by = np.stack([cosine[:, [x == name for x in model.langs]].max(axis=1) for name in names], axis=1)
                best = by.argmax(axis=1)
                weights = np.exp(SHARPNESS * (by - by.max(axis=1, keepdims=True)))
                sure = weights[np.arange(n), best] / weights.sum(axis=1)
                place = cosine.argmax(axis=1)
                empty = ~v.any(axis=1)
                for d in np.flatnonzero(lettered):
                    langs[d] = model.commonest if empty[d] else names[best[d]]
                    score[d] = model.share if empty[d] else sure[d]
                near = np.where(lettered, cosine.max(axis=1), 0.0)
                rejected = near < model.radius[place]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()),
                 pa.array(near.astype(np.float64)), pa.array(rejected | ~lettered)],
                ["doc_id", "held_out", "lang_pred", "score", "cosine", "rejected"],
            )

    return each


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, text) to lang_pred, score (0 to 1, share of the languages' weights),
    cosine to the nearest centroid, and whether it lies outside that centroid's radius."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(
        _predict(shared), "doc_id long, held_out boolean, lang_pred string, score double, cosine double, rejected boolean"
    )


@query("op10_language_centroids")
def op10_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. Clustering is beyond SQL; tests hold out a fold."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), (fold(4) == 2).alias("held_out"),
    )
    model = fit(docs.where("NOT held_out").select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "held_out", "text"), model)
