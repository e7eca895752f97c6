"""Toxicity by the nearest labelled examples, exact by TF-IDF cosine, over a block-max index.

The index holds about ``PER_CLASS`` labelled texts of each class (the documented bound). All their
words are terms, weighted by damped counts, by inverse document frequency over *all* documents, and
by how far the word tells the classes apart there: chi-squared c of presence against label counts
c^2 / (c^2 + ``CHI2``^2), ``LEAST`` at least. So an insult outweighs the chance words around it, and
a text without one still has its neighbours.

Postings are kept by term, examples in blocks; for each block and term the largest weight is known,
which bounds the cosine of every example in it. A text visits blocks in the order of that bound
and stops when no block can hold one nearer than the ``NEIGHBOURS`` found, so the neighbours are
exact. Of equal cosines the example with the smaller number comes first.

Each neighbour votes for its label with weight 1 / (distance + 0.05). The vote is turned into a
probability by a logistic curve fitted on the examples themselves, each left out of its own vote,
with the classes weighted to their shares among all labelled rows. Texts without any word of an
example have no neighbours; they get the share of label 1 among such examples, or among all.

Null and empty texts have no words. Without labelled rows of both classes all scores are the
share of label 1. Repeated rows and ids get a row each; labels repeated for an id count as 1 if
any is 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import class_shares, fold, labelled_sample, pieces, query, table
from gaugeworks.llm.tokens import ALNUM, split

PER_CLASS = 2000
#: Chi-squared at which a word counts half. With full classes a word of toxic texts only has it in
#: some 15 of them.
CHI2 = 15.0
LEAST = 0.002
NEIGHBOURS = 15
BLOCK = 64
#: Blocks that are visited first; twice as many each time after that.
AT_ONCE = 8


def _terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes, and the text number of each."""
    words = split(column, ALNUM)
    return words.hashes(), np.repeat(np.arange(len(column)), words.counts())


def term_weights(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, sorted, and how far each tells the classes apart."""
    pairs = []
    for text in texts:
        pairs.append(np.unique(split(pa.array([text], pa.string()), ALNUM).hashes()))
    owner = np.repeat(y.astype(np.int64), [len(p) for p in pairs])
    terms, at = np.unique(np.concatenate(pairs) if pairs else np.zeros(0, np.uint64), return_inverse=True)
    seen = np.stack([np.bincount(at[owner == k], minlength=len(terms)) for k in (0, 1)], axis=1).astype(float)
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    total = seen.sum(axis=1, keepdims=True)
    expected = total * n / n.sum()
    rest = np.maximum(1 - total[:, 0] / n.sum(), 1e-9)
    chi2 = np.where(total[:, 0] < n.sum(), ((seen - expected) ** 2 / np.maximum(expected, 1e-9)).sum(axis=1) / rest, 0.0)
    return terms, np.maximum(chi2**2 / (chi2**2 + CHI2**2), LEAST)


def _look_up(terms: np.ndarray, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term numbers, owners) of the words that are terms."""
    if not len(terms):
        none = np.zeros(0, np.int64)
        return none, none
    at = np.searchsorted(terms, hashes)
    at[at == len(terms)] = 0
    hit = terms[at] == hashes
    return at[hit], owner[hit]


def _frequencies(terms: np.ndarray):
    def each(batches):
        total, texts = np.zeros(len(terms), np.int64), 0
        for batch in pieces(batches):
            at, owner = _look_up(terms, *_terms_of(batch.column("text")))
            pairs = np.unique(owner * max(len(terms), 1) + at)
            total += np.bincount(pairs % max(len(terms), 1), minlength=len(terms))[: len(terms)]
            texts += batch.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, some)), pa.array(np.append(texts, total[some]))], ["term", "n"])

    return each


class Index:
    """Labelled examples as unit vectors over the terms: postings by term, examples in blocks."""

    def __init__(self, terms: np.ndarray, value: np.ndarray, texts: list[str], y: np.ndarray, ids: list[int], share: float):
        """``value``: what a term's damped count is multiplied with."""
        self.terms, self.value, self.share = terms, value, share
        vectors = [self.vector(_look_up(terms, *_terms_of(pa.array([text], pa.string())))[0]) for text in texts]
        some = np.array([len(v[0]) > 0 for v in vectors], bool)
        # Examples with the same strongest term side by side make blocks with sharp bounds.
        strongest = np.array([int(v[0][np.argmax(v[1])]) if len(v[0]) else -1 for v in vectors], np.int64)
        order = np.lexsort((np.arange(len(texts)), strongest))
        order = order[some[order]]
        self.y, self.ids = y[order].astype(np.float64), [ids[i] for i in order]
        self.weight = np.where(y == 1, share / max((y == 1).mean(), 1e-9), (1 - share) / max((y == 0).mean(), 1e-9))
        without = ~some
        self.floor = float(np.average(y[without], weights=self.weight[without])) if without.any() else share
        self.weight = self.weight[order]
        vectors = [vectors[i] for i in order]
        self.n_blocks = -(-len(vectors) // BLOCK)
        term = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, np.int64)
        example = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        weights = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        by = np.lexsort((example, term))
        self.example, self.posting = example[by].astype(np.int32), weights[by].astype(np.float32)
        self.start = np.searchsorted(term[by], np.arange(len(terms) + 1))
        # The block maxima: one entry for each term and block that has it.
        key = term[by] * max(self.n_blocks, 1) + self.example // BLOCK
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.block = (key[first] % max(self.n_blocks, 1)).astype(np.int32)
        self.most = np.maximum.reduceat(self.posting, first) if len(first) else np.zeros(0, np.float32)
        self.block_start = np.searchsorted(key[first] // max(self.n_blocks, 1), np.arange(len(terms) + 1))
        self.begin, self.end = first, np.append(first[1:], len(key))  #: postings of each entry
        self.slope, self.level = 1.0, 0.0
        self._calibrate(vectors)

    def vector(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        terms, counts = np.unique(at, return_counts=True)
        weights = np.log1p(counts) * self.value[terms]
        length = np.linalg.norm(weights)
        return terms, weights / length if length > 0 else weights

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k nearest examples as (-cosine, number), nearest first."""
        n = self.block_start[terms + 1] - self.block_start[terms]
        entry = _ranges(self.block_start[terms], n)
        of, block = np.repeat(weights, n), self.block[entry]
        bound = np.bincount(block, weights=of * self.most[entry], minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        cosines, numbers = np.zeros(0), np.zeros(0, np.int64)
        done, more = 0, AT_ONCE
        while done < len(order):
            full = len(cosines) == k
            now = order[done : done + more]
            done, more = done + more, 2 * more
            now = now[(bound[now] > 0) & (bound[now] >= (cosines[-1] - 1e-6 if full else 0))]
            if not len(now):
                break
            wanted = np.zeros(self.n_blocks, bool)
            wanted[now] = True
            own = np.flatnonzero(wanted[block])
            size = self.end[entry[own]] - self.begin[entry[own]]
            at = _ranges(self.begin[entry[own]], size)
            cosine = np.bincount(self.example[at], weights=np.repeat(of[own], size) * self.posting[at], minlength=len(self.y))
            near = np.flatnonzero(cosine > (cosines[-1] - 1e-6 if full else 0))
            near = near[near != without]
            cosines, numbers = np.append(cosines, cosine[near]), np.append(numbers, near)
            first = np.lexsort((numbers, -np.round(cosines, 6)))[:k]
            cosines, numbers = cosines[first], numbers[first]
        return [(-float(c), int(i)) for c, i in zip(cosines, numbers, strict=True)]

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Between -1 and 1; the classes weigh as among all labelled rows."""
        number = np.array([i for _, i in near])
        weight = self.weight[number] / (1 + np.array([c for c, _ in near]) + 0.05)
        return float((weight * (2 * self.y[number] - 1)).sum() / weight.sum())

    def _calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        votes, y, weight = [], [], []
        for i, v in enumerate(vectors):
            near = self.nearest(*v, NEIGHBOURS, without=i)
            if near:
                votes.append(self.vote(near))
                y.append(self.y[i])
                weight.append(self.weight[i])
        x, y, weight = np.array(votes), np.array(y), np.array(weight)
        if not len(x):
            return
        # Newton steps with a little shrinkage, so that separable votes stay finite.
        a, b = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(weight * (p - y) * x).sum() + 0.1 * a, (weight * (p - y)).sum() + 0.1 * b])
            s = weight * p * (1 - p)
            h = np.array([[(s * x * x).sum() + 0.1, (s * x).sum()], [(s * x).sum(), s.sum() + 0.1]])
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
        self.slope, self.level = float(a), float(b)

    def score(self, near: list[tuple[float, int]]) -> float:
        if not near:
            return self.floor
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.vote(near) + self.level, -30, 30))))


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Numbers of several ranges, one after the other."""
    return np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)


def _score(shared_index, share: float):
    def each(batches):
        index = shared_index.value
        for batch in pieces(batches):
            score = np.full(batch.num_rows, share if index is None else index.floor)
            nearest, evidence = np.zeros(batch.num_rows), [""] * batch.num_rows
            if index is not None:
                at, owner = _look_up(index.terms, *_terms_of(batch.column("text")))
                begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else []
                for a, b in zip(begin, np.append(begin[1:], len(owner)), strict=True) if len(owner) else []:
                    near = index.nearest(*index.vector(at[a:b]), NEIGHBOURS)
                    d = int(owner[a])
                    score[d], nearest[d] = index.score(near), -near[0][0] if near else 0.0
                    evidence[d] = ",".join(str(index.ids[i]) for _, i in near)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(nearest), pa.array(evidence, pa.string())],
                ["doc_id", "held_out", "score", "cosine", "evidence"],
            )

    return each


def fit(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int = PER_CLASS) -> Index | None:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = labelled_sample(labels, label, modulus, held_out, per_class)
    # The sample is bounded by per_class, and so is what is broadcast and collected.
    rows = sorted(docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y").collect())
    once = {r["text"]: r for r in reversed(rows)}  # of copies the first
    rows = sorted(once.values())
    texts, y = [r["text"] for r in rows], np.array([r["y"] for r in rows], np.float64)
    if len(set(y)) < 2:
        return None
    terms, telling = term_weights(texts, y)
    seen = docs.select("text").mapInArrow(_frequencies(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = seen.toPandas().set_index("term")["n"].reindex(range(-1, len(terms)), fill_value=0).to_numpy()  # a row a term
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    return Index(terms, idf * telling, texts, y, [r["doc_id"] for r in rows], class_shares(labels, label, modulus, held_out))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. The fit is beyond SQL; tests hold it against all cosines and a fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = fit(docs, labels, "toxic", 4, 2)
    share = index.share if index is not None else class_shares(labels, "toxic", 4, 2)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(4) == 2).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    scored = rows.mapInArrow(
        _score(spark.sparkContext.broadcast(index), share), "doc_id long, held_out boolean, score double, cosine double, evidence string"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
